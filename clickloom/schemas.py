"""Schemas of the input and output tables, as DDL text.

Times are typed at the edge: ``action_time`` is a timestamp, dates stay ``yyyy-MM-dd`` text
(the tables are partitioned by it and compared as text).
"""

from __future__ import annotations

USER_VISIT_ACTION = """
    date string, user_id bigint, session_id string, page_id bigint, action_time timestamp,
    search_keyword string, click_category_id bigint, click_product_id bigint,
    order_category_ids string, order_product_ids string,
    pay_category_ids string, pay_product_ids string,
    city_id bigint, action_id bigint
"""

USER_INFO = (
    "user_id bigint, username string, name string, age int, professional string, "
    "city string, sex string"
)

PRODUCT_INFO = "product_id bigint, product_name string, extend_info string"

CITY_INFO = "city_id bigint, city_name string, area string"

NEWS_ACCESS = (
    "date string, timestamp bigint, userid bigint, pageid bigint, section string, action string"
)

TASK = "task_id bigint, task_param string"

INPUTS = {
    "user_visit_action": USER_VISIT_ACTION,
    "user_info": USER_INFO,
    "product_info": PRODUCT_INFO,
    "city_info": CITY_INFO,
    "news_access": NEWS_ACCESS,
    "task": TASK,
}

# Columns of the result tables, in order.
OUTPUT_COLUMNS = {
    "session_aggr_stat": [
        "task_id", "session_count",
        "visit_length_1s_3s_ratio", "visit_length_4s_6s_ratio", "visit_length_7s_9s_ratio",
        "visit_length_10s_30s_ratio", "visit_length_30s_60s_ratio", "visit_length_1m_3m_ratio",
        "visit_length_3m_10m_ratio", "visit_length_10m_30m_ratio", "visit_length_30m_ratio",
        "step_length_1_3_ratio", "step_length_4_6_ratio", "step_length_7_9_ratio",
        "step_length_10_30_ratio", "step_length_30_60_ratio", "step_length_60_ratio",
    ],
    "session_random_extract": [
        "task_id", "session_id", "start_time", "search_keywords", "click_category_ids",
    ],
    "top10_category": ["task_id", "category_id", "click_count", "order_count", "pay_count"],
    "top10_session": ["task_id", "category_id", "session_id", "click_count"],
    "session_detail": [
        "task_id", "user_id", "session_id", "page_id", "action_time", "search_keyword",
        "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
        "pay_category_ids", "pay_product_ids",
    ],
    "page_split_convert_rate": ["task_id", "convert_rate"],
    "area_top3_product": [
        "task_id", "area", "area_level", "product_id", "city_infos", "click_count",
        "product_name", "product_status",
    ],
    "ad_user_click_count": ["date", "user_id", "ad_id", "click_count"],
    "ad_blacklist": ["user_id"],
    "ad_stat": ["date", "province", "city", "ad_id", "click_count"],
    "ad_province_top3": ["date", "province", "ad_id", "click_count"],
    "ad_click_trend": ["date", "hour", "minute", "ad_id", "click_count"],
}
