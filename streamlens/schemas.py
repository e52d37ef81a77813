"""Record types as Spark DDL. Event times arrive as epoch numbers and become timestamps at parse."""

USER_BEHAVIOR = "userID BIGINT, itemID BIGINT, categoryID BIGINT, behavior STRING, timestamp BIGINT"
USER_NET_FLOW = "userId BIGINT, behavior STRING, url STRING, timestamp BIGINT"
TRANSACTION = (
    "client_id STRING, client_name STRING, transaction_amount BIGINT, "
    "transfer_accounts BIGINT, time BIGINT"
)
PRODUCT_TRANSACTION = (
    "client_id STRING, product_name STRING, transaction_amount BIGINT, "
    "transfer_accounts BIGINT, time BIGINT"
)
USER_EVENT = "id STRING, name STRING, time BIGINT"
PAGE_COUNT = "url STRING, count BIGINT, windowend TIMESTAMP"
CATEGORY_COUNTS = "categoryID BIGINT, heat BIGINT, windowend TIMESTAMP"
ACCOUNT = "fund_account STRING, open_date STRING, xz STRING, zt STRING"
RULE = "ts TIMESTAMP, tier STRING, rule STRING"
EVENT = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)
# an event with its value in cents and the number of its properties
CENT_EVENT = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, c BIGINT, k BIGINT"
)
