"""Record shapes, written as DDL."""

TOPIC = "topic STRING, partition INT, offset BIGINT, key STRING, value STRING, timestamp TIMESTAMP"
TOPIC_COLUMNS = ["topic", "partition", "offset", "key", "value", "timestamp"]

# Log JSON is read as text throughout: producers may or may not quote numbers.
APP_LOG_JSON = (
    "ts STRING, common STRUCT<mid: STRING, uid: STRING, ar: STRING, ch: STRING, vc: STRING>, "
    "start STRING, _corrupt_record STRING"
)

DAU_COLUMNS = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts"]
DAU = "mid STRING, uid STRING, ar STRING, ch STRING, vc STRING, dt STRING, hr STRING, mi STRING, ts BIGINT"

ORDER_FIELDS = {
    "id": "bigint",
    "province_id": "bigint",
    "order_status": "string",
    "user_id": "bigint",
    "final_total_amount": "double",
    "benefit_reduce_amount": "double",
    "original_total_amount": "double",
    "feight_fee": "double",
    "expire_time": "string",
    "create_time": "string",
    "operate_time": "string",
}
ORDER_DERIVED = [
    "create_date", "create_hour", "if_first_order",
    "province_name", "province_area_code", "province_iso_code",
    "user_age_group", "user_gender",
]
ORDER_WIDE_COLUMNS = [*ORDER_FIELDS, *ORDER_DERIVED]
ORDER_WIDE = ", ".join(
    [f"{name} {kind}" for name, kind in ORDER_FIELDS.items()] + [f"{name} string" for name in ORDER_DERIVED]
)

PROVINCE_FIELDS = {"id": "string", "name": "string", "area_code": "string", "iso_code": "string"}
USER_FIELDS = {"id": "string", "user_level": "string", "birthday": "string", "gender": "string"}

PROVINCE = "id STRING, name STRING, area_code STRING, iso_code STRING"
USER = "id STRING, user_level STRING, birthday STRING, gender STRING, age_group STRING, gender_name STRING"
USER_STATUS = "user_id STRING, if_consumed STRING, first_order_id BIGINT"
DOCUMENT = "id BIGINT, name STRING, doubanScore FLOAT, actorList ARRAY<STRUCT<id: BIGINT, name: STRING>>"
FIRST_OPEN = "dt STRING, mid STRING, hr STRING, ts BIGINT, partition INT, offset BIGINT"
HOURLY = "dt STRING, hr STRING, n BIGINT"
FIRST_SEEN = "mid STRING, first_dt STRING"
LEDGER = "topic STRING, `group` STRING, partition INT, until_offset BIGINT"
REJECT = "topic STRING, partition INT, offset BIGINT, value STRING, reason STRING"
