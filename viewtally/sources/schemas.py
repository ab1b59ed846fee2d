"""Declared schemas of the logs. Every field is a nullable string unless a
type is given; type drift between days ends in a null, not in a failed read."""

from __future__ import annotations

# Columns of the logs that the reports use.
PLAY = {
    "userId": "string", "accountId": "bigint", "groupId": "string", "event": "string",
    "contentType": "string", "videoSid": "string", "videoName": "string", "episodeSid": "string",
    "pathMain": "string", "pathSub": "string", "pathSpecial": "string", "path": "string",
    "duration": "bigint", "apkVersion": "string", "productModel": "string",
    "promotionChannel": "string", "datetime": "timestamp", "day": "date",
}
LOGIN = {
    "userId": "string", "mac": "string", "wifiMac": "string", "version": "string",
    "productModel": "string", "promotionChannel": "string", "ip": "string",
    "datetime": "timestamp", "day": "date",
}
ACCOUNT = {
    "id": "bigint", "user_id": "string", "mac": "string", "wifi_mac": "string",
    "openTime": "timestamp", "lastLoginTime": "timestamp", "ip": "string",
    "product_model": "string", "product_serial": "string", "userType": "int",
    "promotion_channel": "string", "current_version": "string", "origin_type": "string",
    "sn": "string",
}
HOME_ACCESS = {
    "userId": "string", "event": "string", "accessArea": "string", "accessLocation": "string",
    "locationIndex": "string", "apkVersion": "string", "datetime": "timestamp", "day": "date",
}
INTERVIEW = {
    "userId": "string", "event": "string", "contentType": "string", "path": "string",
    "duration": "bigint", "apkVersion": "string", "datetime": "timestamp", "day": "date",
}
LIVE = {
    "userId": "string", "event": "string", "liveType": "string", "sourceType": "string",
    "liveName": "string", "channelSid": "string", "liveMenuCode": "string",
    "pathMain": "string", "duration": "bigint", "datetime": "timestamp", "day": "date",
}
CRASH = {
    "MAC": "string", "APP_VERSION_NAME": "string", "APP_VERSION_CODE": "bigint",
    "CRASH_KEY": "string", "STACK_TRACE": "string", "DATE_CODE": "bigint",
    "PRODUCT_CODE": "string", "day": "date",
}
# One source of the play-quality log with its tries, and the nested document of that log.
QOS_SOURCE = """
struct<videoSource:string, sourceIndex:bigint, sourceSwitch:string,
  sourcecases:array<struct<playCode:int, playerType:string, parseDuration:bigint,
   initBufferDuration:bigint, preAdDuration:bigint, mediumAdDuration:bigint,
   postAdDuration:bigint, totalBufferTimes:bigint, totalBufferDuration:bigint,
   playDuration:bigint, bufferDurations:array<bigint>>>>
""".replace("\n", "")
QOS_DOCUMENT = f"""
struct<userId:string, aid:string, pathMain:string, pathSpecial:string, pathSub:string,
 accountId:string, contentType:string, videoSid:string, episodeSid:string, playType:string,
 uploadTime:string, initDuration:bigint, getVideoInfoDuration:bigint, playStatus:bigint,
 avgDownloadSpeed:bigint, playRate:double, playqos:array<{QOS_SOURCE}>>
""".replace("\n", "")
