"""Path rules on written-out cases, with null, empty and short paths."""

import pytest
from pyspark.sql import functions as F

from viewtally.functions import paths as P


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "p string").select(expr(F.col("p")).alias("x")).first()["x"]


@pytest.mark.parametrize("path,i,j,want", [
    ("home*classification*movie-movie*院线大片", 1, 3, "movie"), ("home*classification*movie-movie*院线大片", 2, 2, "院线大片"),
    ("home*classification*movie-movie*院线大片", 3, 1, None), ("kids_home", 1, 1, "kids_home"), ("kids_home", 1, 2, None),
    ("kids_home", 2, 1, None), (None, 1, 1, None),
])
def test_path_part(spark, path, i, j, want):
    assert one(spark, path, lambda c: P.path_part(c, i, j)) == want


@pytest.mark.parametrize("path,code,name", [
    ("subject-新闻头条-hot11", "hot11", "新闻头条"), ("subject-儿歌一周热播榜", None, "儿歌一周热播榜"), ("tag-hot11", None, None),
    ("subject-a-b-hot2", "hot2", "a-b"), (None, None, None),
])
def test_subject(spark, path, code, name):
    assert one(spark, path, P.subject_code_3x) == code
    assert one(spark, path, P.subject_name) == name


@pytest.mark.parametrize("path,want", [
    ("home-hotrecommend-1-2-hot11", [("hot11", "hotrecommend")]),
    ("home-hotrecommend-1-2-hot11-movie3", [("movie3", "hotrecommend"), ("hot11", "hotrecommend")]),
    ("home-kids_home-a-kids7", [("kids7", "a")]), ("home-kids_home-a-b-kids7", [("kids7", "b")]),
    ("home-tv-abc-tv1-actor", [("tv1", "abc"), ("actor", "abc")]), ("home-hot-hot5", [("hot5", "hot")]), ("home-search-x", []), (None, []),
])
def test_subjects_2x(spark, path, want):
    assert [tuple(r) for r in one(spark, path, P.subjects_2x)] == want


@pytest.mark.parametrize("path,want", [
    ("home*classification*tv-tv*x", "分类入口"), ("home*my_tv*history", "历史"), ("home*my_tv*tv", "自定义入口"),
    ("thirdparty", "其它3"), (None, "未知3x"), ("home*my_tv*collect-x", "收藏"),
])
def test_entrance_3x(spark, path, want):
    assert one(spark, path, P.entrance_3x) == want


@pytest.mark.parametrize("path,want", [("home-history-x", "历史"), ("home-tv-x", "其它2"), (None, "未知2x")])
def test_entrance_2x(spark, path, want):
    assert one(spark, path, P.entrance_2x) == want


@pytest.mark.parametrize("path,want", [
    ("home*classification*jilu-jilu*前沿科技", ("jilu", "前沿科技", None)), ("movie*院线大片", (None, None, None)),
    ("home*classification*movie-movie-retrieval*hot*xiju*gangtai*all", ("movie", "筛选", None)),
    ("movie-retrieval*hot*xiju*gangtai*all", ("movie", "筛选", None)), ("home*my_tv*tv-tv-search*DQD", ("tv", "搜索", None)),
    ("home-search-x", (None, None, None)), ("home*recommendation*1-hot*今日焦点", ("hot", "今日焦点", None)),
    ("home*classification*kids-kids_home-kandonghua*4-6岁", ("kids", "kandonghua", "4-6岁")),
    ("home*live*eagle-mv*function*site_concert-mv_category*华语", ("mv", "site_concert", "华语")),
    ("mv*function*site_hotsinger-mv_poster", ("mv", "site_hotsinger", "")),
    ("home*classification*3-sports*League*ouguan-league*赛事回顾", ("sports", "League", "ouguan")), (None, (None, None, None)),
])
def test_list_category_3x(spark, path, want):
    assert tuple(one(spark, path, P.list_category_3x)) == want


@pytest.mark.parametrize("path,want", [
    ("home-movie-movie_hot", ("movie", "movie_hot")), ("home-search-x", ("search", "")),
    ("home-kids_home-kids_seecartoon", ("kids", None)), ("home-otherswatch-1", (None, None)), (None, (None, None)),
])
def test_list_category_2x(spark, path, want):
    assert tuple(one(spark, path, P.list_category_2x))[:2] == want


@pytest.mark.parametrize("path,want", [
    ("home-kids_home", "kids_recommend"), ("kids_home", None), ("x-kids_home-kids_anim*卫视同步", "kids_anim"),
])
def test_kids_category(spark, path, want):
    assert one(spark, path, lambda c: P.kids_levels_3x(c)[1]) == want


def test_kids_tab_is_renamed(spark):
    assert one(spark, "x-kids_home-kids_anim*卫视同步", lambda c: P.kids_levels_3x(c)[2]) == "同步卫视"


@pytest.mark.parametrize("path,want", [
    ("home*my_tv*mv-mv*mvTopHomePage*xinge-x", ("音乐入口", "榜单", "新歌榜")), ("home*my_tv*mv-mv*mvTopHomePage*site_mvtop", ("", "", "")),
    ("home*my_tv*mv-mv*mvTopHomePage*site_mvtop-mv_poster", ("音乐入口", "榜单", "更多榜单")),
    ("home*classification*mv-mv*mvRecommendHomePage*qrwy4-mv_station", ("音乐入口", "电台", "")),
    ("home*classification*mv-mv*mvRecommendHomePage*qrwy4", ("音乐入口", "推荐", "")), ("mv-search*abc", ("音乐入口", "音乐搜索", "")),
    ("mv*mvCategoryHomePage*site_mvyear-mv_category*90年代", ("音乐分类", "年代", "90年代")), ("mv*function*site_concert", ("", "", "")),
    ("movie*x", ("", "", "")),
])
def test_music_tabs(spark, path, want):
    assert tuple(one(spark, path, P.music_tabs)) == want


@pytest.mark.parametrize("path,want", [
    (None, ("", "", "")), ("a-mv*function*site_x", ("mv", "function", "site_x")), ("a-mv*horizontal*personal_12", ("mv", "horizontal", "personal")),
    ("a-mv*horizontal*12ab", ("mv", "horizontal", None)), ("mv-search", ("mv", "function", "search")), ("mv*x", ("", "", "")),
])
def test_music_home_location(spark, path, want):
    assert tuple(one(spark, path, P.music_home_location)) == want


def test_search_keyword(spark):
    assert one(spark, "home-search-CNWD", P.search_keyword_2x) == "CNWD"
    assert one(spark, "home-movie-x", P.search_keyword_2x) is None
