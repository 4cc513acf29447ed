"""DuckDB SQL giving the same rows as the queries of registry/queries.py."""

from __future__ import annotations

from clickloom.registry import queries as q

_SEC = (
    "(event_id*7919) % (case user_id%5 when 0 then 4 when 1 then 10 when 2 then 60 "
    "when 3 then 600 else 7200 end)"
)

_VIEWS = {
    "e": f"""
        select event_id, user_id, event_type,
               cast(json_extract_string(props, '$.k') as bigint) as k,
               strftime(ts, '%Y-%m-%d') as d,
               date_trunc('day', ts) + to_seconds({_SEC}) as a_ts,
               epoch_us(ts) // 1000 as ms,
               ts
        from events""",
    "user_visit_action": """
        select d as date, user_id, concat(user_id, '_', d) as session_id, k%10 as page_id,
               a_ts as action_time,
               case when event_type='view' then concat('kw', k%10) end as search_keyword,
               case when event_type='click' then k%20 end as click_category_id,
               case when event_type='click' then event_id%150 end as click_product_id,
               case when event_type='signup' then concat(k%20, ',', (k+7)%20) end
                   as order_category_ids,
               case when event_type='signup' then cast(event_id%150 as varchar) end
                   as order_product_ids,
               case when event_type='purchase' then cast(k%20 as varchar) end
                   as pay_category_ids,
               case when event_type='purchase' then cast(event_id%150 as varchar) end
                   as pay_product_ids,
               user_id%25 as city_id, event_id as action_id
        from e""",
    "user_info": """
        select c_custkey as user_id, c_name as username, c_name as name,
               cast(c_custkey%60 as int) as age, c_mktsegment as professional, n_name as city,
               case when c_custkey%2=0 then 'male' else 'female' end as sex
        from customer join nation on c_nationkey=n_nationkey""",
    "product_info": """
        select p_partkey as product_id, p_name as product_name,
               concat('{"product_status": ', p_partkey%2, '}') as extend_info
        from part""",
    "city_info": """
        select cast(n_nationkey as bigint) as city_id, n_name as city_name,
               case n_regionkey when 0 then 'China North' when 1 then 'China East'
                    when 2 then 'China South' when 3 then 'West North' else 'East North' end
                   as area
        from nation""",
    "news_access": """
        select d as date, ms as timestamp,
               case when event_type<>'signup' and k%10<>0 then user_id end as userid,
               case when event_type<>'signup' then k end as pageid,
               case when event_type<>'signup' then concat('section', k%10) end as section,
               case when event_type='signup' then 'register' else 'view' end as action
        from e""",
    "clicks": """
        select ms, d as date, ts, replace(r_name, ' ', '_') as province, n_name as city, user_id,
               k%10 as ad_id
        from e join nation on n_nationkey=user_id%25 join region on r_regionkey=n_regionkey""",
    "sessions": """
        select s.*, u.age, u.professional, u.city, u.sex
        from (select session_id, min(user_id) as user_id,
                     coalesce(string_agg(distinct search_keyword, ',' order by search_keyword), '')
                         as search_keywords,
                     coalesce(array_to_string(list_sort(list(distinct click_category_id)
                         filter (where click_category_id is not null)), ','), '')
                         as click_category_ids,
                     date_diff('second', min(action_time), max(action_time)) as visit_length,
                     count(*) as step_length,
                     strftime(min(action_time), '%Y-%m-%d %H:%M:%S') as start_time
              from user_visit_action group by session_id) s
        join user_info u on s.user_id = u.user_id""",
    "filtered": """
        select * from sessions
        where age between 10 and 50
          and professional in ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
          and sex = 'male'
          and list_has_any(string_split(search_keywords, ','), ['kw1','kw2','kw3','kw4','kw5'])""",
    "details": """
        select * from user_visit_action
        where session_id in (select session_id from filtered)""",
    "category_events": """
        select click_category_id as category_id, 'click' as kind from details
        where click_category_id is not null
        union all
        select cast(unnest(string_split(order_category_ids, ',')) as bigint), 'order'
        from details where order_category_ids is not null
        union all
        select cast(unnest(string_split(pay_category_ids, ',')) as bigint), 'pay'
        from details where pay_category_ids is not null""",
    "category_counts": """
        select category_id, count(*) filter (where kind='click') as click_count,
               count(*) filter (where kind='order') as order_count,
               count(*) filter (where kind='pay') as pay_count
        from category_events group by category_id""",
    "top_categories": """
        select * from category_counts
        order by click_count desc, order_count desc, pay_count desc, category_id limit 10""",
    "top_sessions": """
        select category_id, session_id, click_count from (
            select *, row_number() over (partition by category_id
                                         order by click_count desc, session_id) as nth
            from (select click_category_id as category_id, session_id, count(*) as click_count
                  from details
                  where click_category_id in (select category_id from top_categories)
                  group by 1, 2))
        where nth <= 3""",
    "top_details": """
        select d.* from details d join top_sessions s on d.session_id = s.session_id""",
    "transitions": """
        select * from (
            select session_id,
                   lag(page_id) over w as from_page, page_id as to_page,
                   row_number() over w as nth
            from user_visit_action
            window w as (partition by session_id order by action_time, action_id))
        where nth > 1""",
    "start_pv": f"select count(*) as pv from user_visit_action where page_id = {q.FLOW[0]}",
    "area_clicks": """
        select area, click_product_id as product_id, count(*) as click_count,
               string_agg(distinct concat(city_id, ':', city_name), ','
                          order by concat(city_id, ':', city_name)) as city_infos
        from user_visit_action join city_info using (city_id)
        where click_product_id is not null
        group by area, click_product_id""",
    "area_top": """
        select area,
               case when area in ('China North', 'China East') then 'A Level'
                    when area in ('China South', 'China Middle') then 'B Level'
                    when area in ('West North', 'West South') then 'C Level'
                    else 'D Level' end as area_level,
               product_id, click_count, city_infos, product_name, product_status
        from (select *, row_number() over (partition by area
                                           order by click_count desc, product_id) as nth
              from (select a.*, p.product_name,
                           case when json_extract_string(p.extend_info, '$.product_status') = '0'
                                then 'Self' else 'Third Party' end as product_status
                    from area_clicks a join product_info p on a.product_id = p.product_id))
        where nth <= 3""",
    "user_clicks": """
        select date, user_id, ad_id, count(*) as click_count from clicks group by all""",
    "blacklist": f"""
        select distinct user_id from user_clicks where click_count >= {q.THRESHOLD}""",
    "kept": """
        select * from clicks where user_id not in (select user_id from blacklist)""",
    "stat": """
        select date, province, city, ad_id, count(*) as click_count from kept group by all""",
    "province": """
        select date, province, ad_id, cast(sum(click_count) as bigint) as click_count
        from stat group by date, province, ad_id""",
    "links": """
        select page_id, url, link from (
            select page_id, url, unnest(list_distinct(list_transform(
                regexp_extract_all(html, '(?:src|href)=(?:"[^"]+"|''[^'']+'')', 0),
                lambda m: regexp_replace(m, '^[a-z]+=.|.$', '', 'g')))) as link
            from pages)
        where link <> '' and not (starts_with(link, '#') or starts_with(link, 'javascript:')
                                  or starts_with(link, 'mailto:'))""",
    "resolved": r"""
        select page_id, link,
               case when starts_with(link, '//')
                    then concat(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1), ':', link)
                    when starts_with(link, '/')
                    then concat(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1), '://',
                                regexp_replace(regexp_replace(
                                    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1),
                                    '^.*@', ''), ':80$', ''),
                                link)
                    when regexp_matches(link, '^[hH][tT][tT][pP][sS]?:') then link
                    when not contains(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '/')
                    then concat(url, '/', link)
                    else concat(regexp_replace(url, '/[^/]*$', ''), '/', link) end as target
        from links""",
    "tasks": """
        select c_custkey as task_id,
               concat('{"startDate":["2024-01-', lpad(cast(c_nationkey+1 as varchar), 2, '0'),
                      '"],"startAge":[', c_custkey%60, '],"professionals":["', c_mktsegment,
                      ',IT"],"sex":[],', '"targetPageFlow":["3,', c_nationkey, '","9"]}')
                   as task_param
        from customer""",
}

_VIEWS |= {
    # Clicks that the ad job can read, with the batch they come in, and those it keeps: a user
    # listed by one batch is left out of the later ones.
    "job_clicks": """
        select *, (day(ts) - 1) * 5 // 31 as part from clicks where ad_id <> 3""",
    "job_kept": f"""
        select c.* from job_clicks c left join (
            select user_id, min(part) as listed from (
                select part, date, user_id, ad_id from job_clicks
                group by all having count(*) >= {q.THRESHOLD})
            group by user_id) l on l.user_id = c.user_id
        where listed is null or c.part <= listed""",
}

_NEEDS = {
    "job_clicks": ["clicks"],
    "job_kept": ["job_clicks"],
    "e": [],
    "user_visit_action": ["e"],
    "user_info": [],
    "product_info": [],
    "city_info": [],
    "news_access": ["e"],
    "clicks": ["e"],
    "sessions": ["user_visit_action", "user_info"],
    "filtered": ["sessions"],
    "details": ["filtered"],
    "category_events": ["details"],
    "category_counts": ["category_events"],
    "top_categories": ["category_counts"],
    "top_sessions": ["top_categories"],
    "top_details": ["top_sessions"],
    "transitions": ["user_visit_action"],
    "start_pv": ["user_visit_action"],
    "area_clicks": ["user_visit_action", "city_info"],
    "area_top": ["area_clicks", "product_info"],
    "user_clicks": ["clicks"],
    "blacklist": ["user_clicks"],
    "kept": ["blacklist"],
    "stat": ["kept"],
    "province": ["stat"],
    "links": [],
    "resolved": ["links"],
    "tasks": [],
}


def _with(body: str, *views: str) -> str:
    """``body`` with the common table expressions it needs, in order of dependence."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS[name]:
            need(other)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        need(view)
    ctes = ",\n".join(f"{name} as ({_VIEWS[name]})" for name in ordered)
    return f"with {ctes}\n{body}" if ctes else body


def rounded(x: str) -> str:
    """Half up to two decimals by the exact value of the double ``x`` (not negative)."""
    cents = f"floor({x} * 100 + 0.5e0)"
    hi = f"({x} * 134217729e0 - ({x} * 134217729e0 - {x}))"
    exact = f"({hi} * 200 - ({cents} * 2 {{}})) + ({x} - {hi}) * 200"
    return (
        f"(case when {exact.format('- 1')} < 0 then {cents} - 1 "
        f"when {exact.format('+ 1')} >= 0 then {cents} + 1 else {cents} end) / 100e0"
    )


def _ratio(a: str, b: str) -> str:
    return rounded(f"(cast({a} as double) / nullif({b}, 0))")


_ACTION_TEXT = "replace (strftime(action_time, '%Y-%m-%d %H:%M:%S') as action_time)"


def _length_stats(source: str = "sessions") -> str:
    buckets = {
        "visit_length": "1s_3s 1 3, 4s_6s 4 6, 7s_9s 7 9, 10s_30s 10 30, 30s_60s 31 60, 1m_3m 61 180, "
        "3m_10m 181 600, 10m_30m 601 1800, 30m 1801 9999999999",
        "step_length": "1_3 1 3, 4_6 4 6, 7_9 7 9, 10_30 10 30, 30_60 31 60, 60 61 9999999999",
    }
    counts, ratios = [], []
    for kind, bounds in buckets.items():
        for name, low, high in map(str.split, bounds.split(",")):
            column = f"{kind}_{name}"
            counts.append(f"count(*) filter (where {kind} between {low} and {high}) as {column}")
            ratios.append(f"{_ratio(column, 'session_count')} as {column}_ratio")
    inner = f"select count(*) as session_count, {', '.join(counts)} from {source}"
    return _with(f"select *, {', '.join(ratios)} from ({inner})", source)


def _flow_rates() -> str:
    steps = list(zip(q.FLOW, q.FLOW[1:]))
    values = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(steps, 1))
    return f"""
        select step, page_split, pv, base_pv, {_ratio('pv', 'base_pv')} as convert_rate
        from (select step, page_split, pv,
                     coalesce(lag(pv) over (order by step),
                              (select greatest(pv, 1) from start_pv)) as base_pv
              from (select f.step, concat(f.a, '_', f.b) as page_split,
                           greatest(count(t.session_id), 1) as pv
                    from (values {values}) f(step, a, b)
                    left join transitions t on t.from_page = f.a and t.to_page = f.b
                    group by f.step, f.a, f.b))"""


def _quotas(total: int) -> str:
    """From ``src`` (session_id, date, hour): every day in turn gives one session until the total
    is met; hours share by largest remainder."""
    return f"""
        h as (select date, hour, count(*) as n from src group by date, hour),
        d as (select date, sum(n)::bigint as n from h group by date),
        turns as (select date, unnest(range(n)) as turn from d),
        given as (select date, count(*) as q
                  from (select date from turns order by turn, date limit {total}) group by date),
        parts as (select h.date, h.hour, h.n, coalesce(q, 0) * h.n // d.n as whole,
                         coalesce(q, 0) * h.n % d.n as remainder, coalesce(q, 0) as q
                  from h join d on h.date = d.date left join given on given.date = d.date),
        quotas as (
            select date, hour, n as session_count,
                   (whole + case when row_number() over (partition by date order by remainder desc, hour)
                                 <= q - sum(whole) over (partition by date) then 1 else 0 end)::bigint as quota
            from parts)"""


_SESSION_TIMES = "src as (select *, start_time[1:10] as date, start_time[12:13] as hour from sessions)"
_EVENT_TIMES = """
    src as (select session_id, strftime(t, '%Y-%m-%d') as date, strftime(t, '%H') as hour from (
        select concat(user_id, '_', cast(ts as date)) as session_id, min(ts) as t
        from events group by 1))"""


def _sample(source: str, total: int, columns: str) -> str:
    body = f"""
        {source}, {_quotas(total)}
        select {columns} from (
            select src.*, quota, row_number() over (partition by src.date, src.hour
                order by md5(concat('9:', session_id)), session_id) as nth
            from src join quotas on src.date = quotas.date and src.hour = quotas.hour)
        where nth <= quota"""
    return body


_CLICK_COLUMNS = "ms, date, province, city, user_id, ad_id"
_SESSION_USERS = """
    select s.session_id, s.user_id, s.step_length, u.name, u.professional, u.city
    from (select session_id, min(user_id) as user_id, count(*) as step_length
          from user_visit_action group by session_id) s
    join user_info u on u.user_id = s.user_id"""
_PROVINCE_TOP3 = """
    select date, province, ad_id, click_count from (
        select *, row_number() over (partition by {group} order by click_count desc, ad_id, date)
                  as nth from province)
    where nth <= 3"""
_TREND = """
    select date, strftime(ts, '%H') as hour, strftime(ts, '%M') as minute, ad_id,
           count(*) as click_count
    from clicks group by all"""

_FLOW_PAIRS = ", ".join(f"({a}, {b})" for a, b in sorted(set(zip(q.FLOW, q.FLOW[1:]))))


def oracle_sql() -> dict[str, str]:
    session_users = _with(_SESSION_USERS, "user_visit_action", "user_info")
    transitions = _with("select session_id, from_page, to_page from transitions", "transitions")
    province_top3 = _with(_PROVINCE_TOP3.format(group="date, province"), "province")
    blacklist = _with("select user_id from blacklist", "blacklist")
    stat = _with("select * from stat", "stat")
    trend = _with(_TREND, "clicks")
    top_details = _with(f"select * {_ACTION_TEXT} from top_details", "top_details")
    area_top = _with("select * from area_top", "area_top")
    in_range = f"date >= '{q.START}' and date <= '{q.END}'"
    detail_columns = (
        "cast(1 as bigint) as task_id, user_id, session_id, page_id, action_time, search_keyword, "
        "click_category_id, click_product_id, order_category_ids, order_product_ids, "
        "pay_category_ids, pay_product_ids"
    )
    return {
        "scan_actions": _with(
            f"select * {_ACTION_TEXT} from user_visit_action where {in_range}",
            "user_visit_action",
        ),
        "scan_clicks": _with(
            "select city_id, click_product_id as product_id from user_visit_action "
            f"where click_product_id is not null and {in_range}",
            "user_visit_action",
        ),
        "access_log": _with("select * from news_access", "news_access"),
        "task_params": _with(
            "select task_id, "
            + ", ".join(
                f"json_extract_string(task_param, '$.{f}[0]') as \"{f}\""
                for f in q.params.PARAM_FIELDS
            )
            + " from tasks",
            "tasks",
        ),
        "ad_log_parse": _with(f"select {_CLICK_COLUMNS} from clicks", "clicks"),
        "ad_log_rejects": _with(
            """
            select case when ad_id = 3 then concat(ms, ' ', province, ' ', city, ' ', user_id)
                        else concat('x', ms, ' ', province, ' ', city, ' ', user_id, ' ', ad_id)
                   end as value
            from clicks where ad_id in (3, 4)""",
            "clicks",
        ),
        "session_aggregate": _with("select * from sessions", "sessions"),
        "session_filter": _with("select * from filtered", "filtered"),
        "session_filter_categories": _with(
            "select * from sessions "
            "where list_has_any(string_split(click_category_ids, ','), ['3', '7', '11'])",
            "sessions",
        ),
        "session_length_stats": _length_stats(),
        "session_hourly_counts": _with(
            "select concat(start_time[1:10], '_', start_time[12:13]) as date_hour, "
            "count(*) as session_count from sessions group by 1",
            "sessions",
        ),
        "sample_quotas": _with(
            f", {_SESSION_TIMES}, {_quotas(1000)} select * from quotas", "sessions"
        ),
        "session_sample": _with(
            ", " + _sample(_SESSION_TIMES, 100, "session_id, start_time, search_keywords, click_category_ids"),
            "sessions",
        ),
        "sample_quotas_hours": f"with {_EVENT_TIMES}, {_quotas(100)} select * from quotas",
        "session_sample_hours": "with " + _sample(_EVENT_TIMES, 25, "session_id, date, hour"),
        "session_details": _with(f"select * {_ACTION_TEXT} from details", "details"),
        "category_events": _with(
            """
            select category_id, kind, count(*) as events from (
                select click_category_id as category_id, 'click' as kind
                from user_visit_action where click_category_id is not null
                union all
                select cast(unnest(string_split(order_category_ids, ',')) as bigint), 'order'
                from user_visit_action where order_category_ids is not null
                union all
                select cast(pay_category_ids as bigint), 'pay'
                from user_visit_action where pay_category_ids is not null)
            group by category_id, kind""",
            "user_visit_action",
        ),
        "session_value_chunks": _with(
            """
            , v as (
                select distinct session_id, 'keyword' as kind, search_keyword as v, null::bigint as i
                from user_visit_action where search_keyword <> ''
                union all
                select distinct session_id, 'category', cast(click_category_id as varchar), click_category_id
                from user_visit_action where click_category_id is not null),
            n as (
                select *, row_number() over (partition by session_id, kind order by i, v) - 1 as pos,
                       cast(coalesce(sum(strlen(v) + 1) over (
                           partition by session_id, kind order by i, v rows between unbounded preceding and 1 preceding), 0) as bigint) // 8 as c
                from v)
            select session_id, kind, row_number() over (partition by session_id, kind order by c) - 1 as chunk,
                   min(pos) as position, string_agg(v, ',' order by pos) as "values"
            from n group by session_id, kind, c""",
            "user_visit_action",
        ),
        "area_product_city_chunks": _with(
            """
            , v as (
                select distinct area, click_product_id as product_id, concat(city_id, ':', city_name) as v
                from user_visit_action join city_info using (city_id) where click_product_id is not null),
            n as (
                select *, row_number() over (partition by area, product_id order by v) - 1 as pos,
                       cast(coalesce(sum(strlen(v) + 1) over (
                           partition by area, product_id order by v rows between unbounded preceding and 1 preceding), 0) as bigint) // 30 as c
                from v)
            select area, product_id, row_number() over (partition by area, product_id order by c) - 1 as chunk,
                   min(pos) as position, string_agg(v, ',' order by pos) as city_infos
            from n group by area, product_id, c""",
            "user_visit_action", "city_info",
        ),
        "category_rejects": _with(
            """
            select session_id, 'order' as kind, 'n/a' as value from user_visit_action
            where order_category_ids is not null and page_id = 3
            union all
            select session_id, 'pay', '' from user_visit_action
            where pay_category_ids is not null and page_id = 4""",
            "user_visit_action",
        ),
        "category_counts": _with("select * from category_counts", "category_counts"),
        "top_categories": _with("select * from top_categories", "top_categories"),
        "top_sessions": _with("select * from top_sessions", "top_sessions"),
        "top_session_details": top_details,
        "session_job": _with(
            f"select {detail_columns} from (select * {_ACTION_TEXT} from top_details)",
            "top_details",
        ),
        "session_job_stat": f"""
            select cast(1 as bigint) as task_id, session_count, columns('.*_ratio')
            from ({_length_stats("filtered")})""",
        "session_job_extract": _with(
            ", " + _sample(
                _SESSION_TIMES.replace("from sessions", "from filtered"), 100,
                "cast(1 as bigint) as task_id, session_id, start_time, search_keywords, click_category_ids",
            ),
            "filtered",
        ),
        "session_job_categories": _with(
            "select cast(1 as bigint) as task_id, category_id, click_count, order_count, pay_count "
            "from top_categories",
            "top_categories",
        ),
        "session_job_sessions": _with(
            "select cast(1 as bigint) as task_id, category_id, session_id, click_count from top_sessions",
            "top_sessions",
        ),
        "funnel_job": _with(
            "select cast(1 as bigint) as task_id, string_agg(concat(page_split, '=', "
            f"cast(convert_rate as varchar)), '|' order by step) as convert_rate from ({_flow_rates()})",
            "transitions", "start_pv",
        ),
        "product_job": _with(
            "select cast(1 as bigint) as task_id, area, area_level, product_id, city_infos, click_count, "
            "product_name, product_status from area_top", "area_top",
        ).replace(
            "where click_product_id is not null", f"where click_product_id is not null and {in_range}"
        ),
        "news_job_counts": _with(
            f"""
            select 'page_pv' as kind, cast(pageid as varchar) as name, count(*) as n
            from news_access where action = 'view' and date = '{q.NEWS_DAY}' group by pageid
            union all
            select 'page_uv', cast(pageid as varchar), count(*) from (
                select distinct pageid, userid from news_access
                where action = 'view' and date = '{q.NEWS_DAY}') group by pageid
            union all
            select 'section_pv', section, count(*)
            from news_access where action = 'view' and date = '{q.NEWS_DAY}' group by section""",
            "news_access",
        ),
        "news_job_rates": _with(
            f"""
            select date, registers, anonymous_views, {_ratio('registers', 'anonymous_views')} as register_rate,
                   one_view_users, user_views, {_ratio('one_view_users', 'user_views')} as jump_rate
            from (
                select date, count(*) filter (where action = 'register') as registers,
                       count(*) filter (where action = 'view' and userid is null) as anonymous_views
                from news_access where date = '{q.NEWS_DAY}' group by date),
            (
                select count(*) filter (where n = 1) as one_view_users, cast(sum(n) as bigint) as user_views
                from (select userid, count(*) as n from news_access
                      where action = 'view' and userid is not null and date = '{q.NEWS_DAY}' group by userid))""",
            "news_access",
        ),
        "page_transitions": transitions,
        "page_transitions_split": transitions,
        "page_flow_splits": _with(
            "select concat(from_page, '_', to_page) as page_split, count(*) as pv "
            f"from transitions where (from_page, to_page) in ({_FLOW_PAIRS}) group by 1",
            "transitions",
        ),
        "start_page_pv": _with("select pv as start_pv from start_pv", "start_pv"),
        "page_convert_rates": _with(_flow_rates(), "transitions", "start_pv"),
        "page_convert_text": _with(
            "select string_agg(concat(page_split, '=', cast(convert_rate as varchar)), '|' "
            f"order by step) as convert_rate from ({_flow_rates()})",
            "transitions", "start_pv",
        ),
        "area_product_clicks": _with("select * from area_clicks", "area_clicks"),
        "area_product_sql": _with("select * from area_clicks", "area_clicks"),
        "area_top3_product": area_top,
        "news_page_pv": _with(
            "select date, pageid, count(*) as pv from news_access "
            f"where action = 'view' and date = '{q.NEWS_DAY}' group by date, pageid",
            "news_access",
        ),
        "news_page_uv": _with(
            "select date, pageid, count(*) as uv from "
            "(select distinct date, pageid, userid from news_access where action = 'view') "
            "group by date, pageid",
            "news_access",
        ),
        "news_section_pv": _with(
            "select date, section, count(*) as pv from news_access where action = 'view' "
            "group by date, section",
            "news_access",
        ),
        "news_register_rate": _with(
            f"select *, {_ratio('registers', 'anonymous_views')} as register_rate from ("
            "select date, count(*) filter (where action = 'register') as registers, "
            "count(*) filter (where action = 'view' and userid is null) as anonymous_views "
            "from news_access group by date)",
            "news_access",
        ),
        "news_jump_rate": _with(
            f"select *, {_ratio('one_view_users', 'user_views')} as jump_rate from ("
            "select date, count(*) filter (where n = 1) as one_view_users, "
            "cast(sum(n) as bigint) as user_views from ("
            "select date, userid, count(*) as n from news_access "
            "where action = 'view' and userid is not null group by date, userid) group by date)",
            "news_access",
        ),
        "ad_user_clicks": _with("select * from user_clicks", "user_clicks"),
        "ad_blacklist": blacklist,
        "ad_filtered_clicks": _with(f"select {_CLICK_COLUMNS} from kept", "kept"),
        "ad_stat": stat,
        "ad_province_top3": province_top3,
        "ad_province_top3_all_days": _with(_PROVINCE_TOP3.format(group="province"), "province"),
        "ad_click_trend": trend,
        "ad_blacklist_stream": blacklist,
        "ad_stat_stream": stat,
        "ad_province_top3_stream": province_top3,
        "ad_click_trend_stream": trend,
        "ad_job_user_clicks": _with(
            "select date, user_id, ad_id, count(*) as click_count from job_kept group by all", "job_kept"
        ),
        "ad_job_stat": _with(
            "select date, province, city, ad_id, count(*) as click_count from job_kept group by all",
            "job_kept",
        ),
        "ad_job_top3": _with(
            """
            select date, province, ad_id, click_count from (
                select date, province, ad_id, count(*) as click_count,
                       row_number() over (partition by date, province
                                          order by count(*) desc, ad_id) as nth
                from job_kept group by date, province, ad_id)
            where nth <= 3""",
            "job_kept",
        ),
        "ad_job_trend": _with(
            """
            select date, strftime(ts, '%H') as hour, strftime(ts, '%M') as minute, ad_id,
                   count(*) as click_count
            from job_clicks group by all""",
            "job_clicks",
        ),
        "ad_job_rejects": _with(
            "select concat(ms, ' ', province, ' ', city, ' ', user_id) as value from clicks where ad_id = 3",
            "clicks",
        ),
        "ad_click_trend_sliding": _with(
            """
            select strftime(time_bucket(interval 10 minute, ts) - to_minutes(10 * i),
                            '%Y-%m-%d %H:%M:%S') as window_start,
                   ad_id, count(*) as click_count
            from clicks, range(6) r(i) group by 1, 2""",
            "clicks",
        ),
        "ad_click_trend_panes": _with(
            """
            , windows as (
                select time_bucket(interval 10 second, ts) - to_seconds(10 * i) as s, ad_id, count(*) as n
                from clicks, range(360) r(i) group by 1, 2),
            islands as (
                select cast(s as date) as date, s, ad_id, n, s - to_seconds(10 * row_number() over (
                    partition by cast(s as date), ad_id, n order by s)) as island
                from windows)
            select cast(date as varchar) as date, ad_id, strftime(min(s), '%Y-%m-%d %H:%M:%S') as first_start,
                   strftime(max(s), '%Y-%m-%d %H:%M:%S') as last_start, n as click_count
            from islands group by date, ad_id, n, island""",
            "clicks",
        ),
        "salted_agg": _with(
            "select city_id, count(*) as actions, count(click_product_id) as clicks, "
            "cast(sum(page_id) as bigint) as page_sum, min(action_id) as first_action, "
            "max(action_id) as last_action from user_visit_action group by city_id",
            "user_visit_action",
        ),
        "salted_join": session_users,
        "map_side_join": session_users,
        "skew_split_join": session_users,
        "skew_join": session_users,
        "top_n_per_group": """
            select o_custkey, o_orderkey, o_totalprice, nth from (
                select o_custkey, o_orderkey, o_totalprice,
                       cast(row_number() over (partition by o_custkey
                            order by o_totalprice desc, o_orderkey) as int) as nth
                from orders)
            where nth <= 2""",
        "page_links": _with("select * from resolved", "resolved"),
        "crawl_frontier": _with(
            "select distinct target as url from resolved where contains(target, '.example.') "
            "and target not in (select url from pages where url is not null)",
            "resolved",
        ),
        "crawl_rounds": _with(
            """
            , edges as materialized (
                select distinct p.url, r.target from resolved r join pages p using (page_id)
                where contains(r.target, '.example.')),
            reached(url, depth) as (
                select distinct url, 0 from pages where contains(url, '/en/')
                union
                select e.target, r.depth + 1 from reached r join edges e using (url) where r.depth < 30)
            select url, min(depth) as depth from reached group by url""",
            "resolved",
        ).replace("with ", "with recursive ", 1),
        "number_functions": f"""
            select l_orderkey, l_linenumber,
                   {rounded('(l_extendedprice * l_discount)')} as discount,
                   {rounded('(l_quantity / 200)')} as two_hundredths
            from lineitem""",
        "text_functions": """
            select c_custkey, concat(c_custkey, ':', c_mktsegment) as joined,
                   concat(',', c_name) as trimmed,
                   case when length(cast(c_nationkey as varchar)) = 2
                        then cast(c_nationkey as varchar)
                        else concat('0', c_nationkey) end as padded,
                   c_mktsegment as segment, cast(null as varchar) as note,
                   cast(null as varchar) as x,
                   concat('name=', c_name, '|note=|segment=', c_nationkey, '|x=a=b') as repacked,
                   concat('k_', c_nationkey) as key, true as empty, true as not_empty
            from customer""",
        "json_functions": """
            select event_id, json_extract_string(props, '$.k') as k,
                   cast(null as varchar) as missing, cast(null as varchar) as broken
            from events""",
        "date_functions": """
            select event_id,
                   strftime(ts, '%Y-%m-%d %H:%M:%S') as time, strftime(ts, '%Y-%m-%d') as date,
                   strftime(ts, '%Y%m%d') as date_key, strftime(ts, '%Y%m%d%H%M') as minute,
                   strftime(ts, '%Y-%m-%d_%H') as date_hour, strftime(ts, '%Y-%m-%d') as day,
                   user_id > 0 as before, false as after, user_id * 3600 as seconds,
                   cast(0 as bigint) as unreadable
            from events""",
        "sql_functions": _with(
            "select product_id, concat(product_id, '#', product_name) as joined, "
            "cast(product_id%2 as varchar) as status, product_name as name from product_info",
            "product_info",
        ),
        "append_sink": area_top,
        "upsert_sink": """
            select o_custkey, status, orders, last_order
            from (select o_custkey, max(o_orderstatus) as status, count(*) as orders, max(o_orderkey) as last_order,
                         row_number() over (partition by o_custkey order by step desc) as nth
                  from (select *, case o_orderstatus when 'O' then 0 when 'F' then 1 when 'P' then 2 else 3 end as step
                        from orders)
                  group by o_custkey, step)
            where nth = 1""",
        "replace_groups_sink": """
            select o_orderstatus as status, o_orderpriority,
                   cast(case when o_orderstatus = 'F' then sum(o_custkey) else count(*) end
                        as bigint) as n
            from orders group by o_orderstatus, o_orderpriority""",
    }
