"""Lists, labels and patterns that results depend on.

They are data, kept together and in their natural order. Larger tables (page
details, product brands, location names, black lists) are not listed here;
the operators take them as a dimension table.
"""

# ---------------------------------------------------------------- path lists
# Fixed values, 3.x paths.
LAUNCHER_AREAS_3X = [
    "classification", "my_tv", "live", "recommendation", "foundation", "navi", "hotSubject", "taste",
]
LAUNCHER_LOCATIONS_3X = [
    "history", "collect", "account", "movie", "tv", "zongyi", "jilu", "comic", "xiqu", "kids", "hot",
    "mv", "sport", "top_new", "top_hot", "top_star", "top_collect", "interest_location",
    "0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12", "13", "14",
]
PAGES_3X = [
    "rank", "everyone_watching", "history", "search", "accountcenter_home", "movie", "tv", "zongyi",
    "jilu", "comic", "xiqu", "kids_home", "hot", "mv", "sport_home",
]
LIST_PAGES_3X = [
    "movie", "tv", "zongyi", "jilu", "comic", "xiqu", "collect", "accountcenter_home", "account", "hot",
]
SUB_PATHS = ["similar", "peoplealsolike", "guessyoulike"]
SPECIAL_PROPERTIES = ["subject", "tag", "star"]

# Fixed values, 2.x paths.
NAVI_2X = ["search", "setting"]
CLASSIFICATION_2X = [
    "history", "movie", "tv", "live", "hot", "zongyi", "comic", "mv", "jilu", "xiqu", "sports",
    "kids_home", "subject",
]
UPPER_PART_2X = ["watchhistory", "otherswatch", "hotrecommend", "TVlive"]
LAUNCHER_LOCATIONS_2X = [
    "search", "setting", "history", "movie", "tv", "live", "hot", "zongyi", "comic", "mv", "jilu",
    "xiqu", "sports", "kids_home", "subject",
]
PAGES_2X = [
    "history", "movie", "tv", "zongyi", "hot", "comic", "mv", "xiqu", "sports", "jilu", "subject",
    "live", "search", "kids_home",
]

# Marks that tell which list-page rule applies to a 3.x path.
NO_LIST_PAGE_MARKS = ["mvRecommendHomePage", "home-search"]
LIST_PAGE_MARKS = [
    "home*classification", "home*my_tv", "home*live*eagle", "kids_home-", "sports*", "retrieval",
    "筛选", "search", "搜索", "home*recommendation", "mv*mvCategoryHomePage", "mv*function",
]
RETRIEVAL_LABEL = "筛选"
SEARCH_LABEL = "搜索"
KIDS_SEARCH_LABEL = "搜一搜"
KIDS_MARKS = ["kids", "tingerge", "kandonghua", "xuezhishi"]
KIDS_TAB_FIX = {"卫视同步": "同步卫视"}

# ------------------------------------------------------------ subject codes
# Channels that number their subjects.
SUBJECT_CHANNELS_3X = [
    "movie", "tv", "hot", "kids", "zongyi", "comic", "jilu", "sports", "xiqu", "mv", "game",
]
SUBJECT_CHANNELS_2X = ["hot", "movie", "zongyi", "tv", "comic", "kids", "jilu", "sports", "mv", "xiqu"]

# ------------------------------------------------------------------- labels
# Entrance labels.
ENTRANCE_3X = {
    "home*classification": "分类入口", "home*my_tv*history": "历史", "home*my_tv*collect": "收藏",
    "home*recommendation": "首页推荐", "search": "搜索", "home*hotSubject": "短视频",
    "home*taste": "兴趣推荐",
}
ENTRANCE_CUSTOM = "自定义入口"
ENTRANCE_OTHER_3X = "其它3"
ENTRANCE_2X = {
    "classification": "分类入口", "history": "历史", "hotrecommend": "首页推荐", "search": "搜索",
}
ENTRANCE_OTHER_2X = "其它2"
UNKNOWN = "未知"

# Launcher labels.
LAUNCHER_AREA_LABELS_3X = {
    "my_tv": "我的电视", "recommendation": "今日推荐", "foundation": "发现", "classification": "分类",
    "live": "直播", "menu": "消息中心", "navi": "搜索与设置",
}
LAUNCHER_AREA_LABELS_2X = {
    "1": "热门推荐", "2": "卫视直播", "3": "大家在看", "4": "观看历史", "5": "分类区域",
}
LAUNCHER_LOCATION_LABELS_3X = {
    "history": "历史", "collect": "收藏", "account": "我", "live": "直播", "tv": "电视",
    "movie": "电影", "kids": "少儿", "hot": "资讯短片", "sport": "体育", "application": "应用推荐",
    "jilu": "纪实", "zongyi": "综艺", "xiqu": "戏曲", "mv": "音乐", "comic": "动漫",
    "top_star": "明星榜", "top_collect": "收藏榜", "top_hot": "热播榜", "top_new": "新剧榜",
    "interest_location": "兴趣坐标", "setting": "设置", "search": "搜索", "messageCenter": "消息中心",
}
# Locations of which there is also a form with "site_" in front.
LAUNCHER_SITE_LOCATIONS_3X = [
    "live", "tv", "movie", "kids", "hot", "sport", "application", "jilu", "zongyi", "xiqu", "mv", "comic",
]
# Position 0..14 of the classification area, 2.x.
CLASSIFICATION_POSITIONS_2X = [
    "搜索", "历史收藏", "电影", "电视", "直播", "资讯短片", "综艺", "设置", "少儿", "动漫", "音乐",
    "纪实", "戏曲", "体育", "专题",
]
LAUNCHER_POSITIONS = 20
OTHER = "其他"
OTHER_POSITION = "其他位置"

# Music entry tabs. (mark in the path, needed next part, labels)
MUSIC_ENTRY = "音乐入口"
MUSIC_CATEGORY = "音乐分类"

# Tabs of the collect page, in this order of priority.
COLLECT_TABS = ["收藏追看", "标签订阅", "节目预约", "明星关注", "专题收藏"]
COLLECT_OTHER = "其它"

# Duration labels, upper bound in seconds (inclusive).
DURATION_LABELS = [
    (30, "0-30s"), (60, "30-60s"), (180, "60-180s"), (300, "180-300s"), (900, "5-15min"),
    (1800, "15-30min"), (3600, "30-60min"), (7200, "1-2h"), (10800, "2-3h"), (14400, "3-4h"),
    (18000, "4-5h"), (21600, "5-6h"),
]
DURATION_LONGEST = ">6h"

# Login-count labels, upper bound (inclusive).
LOGIN_COUNT_LABELS = [(5, "登入4-5次"), (8, "登入6-8次"), (15, "登入9-15次")]
LOGIN_COUNT_MOST = "登入大于15次"

# Age bands, upper bound (inclusive).
AGE_BANDS = [(19, "19以下"), (29, "20~29"), (39, "30~39"), (49, "40~49")]
AGE_OLDEST = "50以上"
CALENDAR_MARKS = ["月", "日"]
CITY_DISTRICT = "市辖区"

# Brands told by the start of the product model.
BRAND_PREFIXES = [("MiBOX", "小米盒子"), ("MagicBox", "天猫魔盒")]
BRAND_PREFIX_ANY_CASE = ("10MOONS", "10MOONS")
BRAND_OTHER = "其他品牌"
BRAND_NULL = "NULL"

# Markers of missing or bad keys.
KEY_NULL = "null"
KEY_EMPTY = "kong"
KEY_CORRUPT = "corrupt"
KEY_LONG = "toolong"

# Wi-Fi addresses that identify no device.
INVALID_WIFI_MACS = ["020000000000", "02:00:00:00:00:00"]

# Home country and the label for everything else.
HOME_COUNTRY = "中国"
ABROAD_LABEL = "国外及其他"

# Provinces of the home country, and cut names to complete.
PROVINCES = [
    "上海", "云南", "内蒙古", "北京", "台湾", "吉林", "四川", "天津", "宁夏", "安徽", "山西", "山东", "广东",
    "广西", "新疆", "江苏", "江西", "河北", "河南", "浙江", "海南", "湖北", "湖南", "澳门", "甘肃", "福建",
    "贵州", "辽宁", "重庆", "青海", "香港", "黑龙江", "陕西", "西藏",
]
PROVINCE_FIXES = {"黑龙": "黑龙江", "内蒙": "内蒙古"}

# The channels with rules of their own, the list without third categories, and the site-tree roots
# whose second categories are checked.
SPORTS = "sports"
KIDS = "kids"
MUSIC = "mv"
HORIZONTAL = "horizontal"
LISTED_SITES = ["site_tv", "site_movie", "site_xiqu", "site_comic", "site_zongyi", "site_hot", "site_jilu", "mv_site"]

# Channel labels.
CHANNEL_LABELS = {
    "movie": "电影", "tv": "电视", "hot": "资讯短片", "kids": "少儿", "zongyi": "综艺", "comic": "动漫", "jilu": "纪实",
    "sports": "体育", "xiqu": "戏曲", "mv": "音乐", "game": "游戏",
}
CHANNEL_UNKNOWN = "未知"
