"""The registered queries as plain SQL over the benchmark tables, for comparison in another engine."""

from __future__ import annotations

EVENT_TYPES = "('view','cart','remove_from_cart','purchase')"
RAW_COLUMNS = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"


def money(expression: str) -> str:
    """Order-independent total as double."""
    return f"coalesce(cast(sum(cast({expression} as decimal(18,2))) as double), 0e0)"


def rounded(expression: str, digits: int) -> str:
    scale = f"1e{digits}"
    return f"floor(({expression}) * {scale} + 0.5e0) / {scale}"


def _parts(code: str) -> str:
    return ", ".join(
        f"coalesce(list_extract(string_split({code}, '.'), {i}), 'unknown') as category_level{i}" for i in (1, 2, 3)
    )


# Event views

_EVENT_PART = "from events e join part p on p.p_partkey = cast(e.props->>'k' as bigint)"
_CODE = "p.p_type || '.' || split_part(p.p_name,' ',2) || '.' || split_part(p.p_name,' ',1)"
_CATEGORY = "cast(1487580000000000000 + p.p_size as varchar)"
_SESSION = "'session-' || cast(e.user_id as varchar) || '-' || cast(cast(e.ts as date) as varchar)"
_TYPE = "case e.event_type when 'click' then 'cart' else e.event_type end"

BEHAVIOR_VIEW = f"""behavior as (
  select e.ts as event_time, {_TYPE} as event_type, p.p_partkey as product_id, {_CATEGORY} as category_id,
         lower({_CODE}) as category_code, lower(p.p_brand) as brand, e.value as price, e.user_id,
         {_SESSION} as user_session
  {_EVENT_PART})"""

ORDERS_VIEW = f"""order_behavior as (
  select o.o_orderdate as event_time,
         case l.l_returnflag when 'R' then 'remove_from_cart' when 'A' then 'view' else 'purchase' end as event_type,
         l.l_partkey as product_id, {_CATEGORY} as category_id, lower({_CODE}) as category_code,
         lower(p.p_brand) as brand, l.l_extendedprice as price, o.o_custkey as user_id,
         'session-' || cast(o.o_orderkey as varchar) as user_session
  from lineitem l join orders o on o.o_orderkey = l.l_orderkey join part p on p.p_partkey = l.l_partkey)"""

RAW_VIEW = f"""raw as (
  select d.* exclude (copies) from (
    select case when e.event_id % 103 = 7 then 'not-a-date'
                else strftime(e.ts, '%Y-%m-%d %H:%M:%S') || ' UTC' end as event_time,
           {_TYPE} as event_type, p.p_partkey as product_id,
           case when e.event_id % 31 = 3 then null else {_CATEGORY} end as category_id,
           case when e.event_id % 13 = 5 then null else {_CODE} end as category_code,
           case when e.event_id % 11 = 5 then '  ' else ' ' || p.p_brand || ' ' end as brand,
           case when e.event_id % 101 = 9 then -e.value when e.event_id % 211 = 9 then cast('NaN' as double)
                else e.value end as price,
           case when e.event_id % 107 = 1 then null else e.user_id end as user_id,
           case when e.event_id % 97 = 2 then null when e.event_id % 89 = 2 then 'short'
                else {_SESSION} end as user_session,
           'events-' || cast(cast(e.ts as date) as varchar) || '.csv' as source_file,
           cast(floor(epoch_us(e.ts) / 3600000000) as bigint) as batch,
           case when e.event_id % 50 = 0 then 2 else 1 end as copies
    {_EVENT_PART}) d
  join (select 1 as c union all select 2) x on x.c <= d.copies)"""


def _stored(view: str, first: str, last: str) -> str:
    """Valid typed events with category levels, under the name ``ev``."""
    return f"""ev as (
  select * replace (date_trunc('second', event_time) as event_time), {_parts('category_code')} from {view}
  where price > 0 and not isnan(price) and price < 'Infinity'::double and event_type in {EVENT_TYPES}
    and event_time is not null and user_id is not null and product_id is not null
    and length(user_session) >= 10
    and event_time between timestamp '{first} 00:00:00' and timestamp '{last} 23:59:59')"""


BEH = f"{BEHAVIOR_VIEW}, {_stored('behavior', '2024-01-01', '2024-01-30')}"
ORD = f"{ORDERS_VIEW}, {_stored('order_behavior', '1995-01-01', '2001-08-01')}"
DAY, HALF_YEAR = "interval 1 day", "interval 180 day"

# Raw rows with the first rule each one breaks.
JUDGED = f"""{RAW_VIEW}, timed as (
  select *, try_cast(replace(event_time, ' UTC', '') as timestamp) as t from raw),
judged as (
  select *, case
    when not coalesce(price > 0 and not isnan(price) and price < 'Infinity'::double, false) then 'price'
    when not coalesce(event_type in {EVENT_TYPES}, false) then 'event_type'
    when event_time is null or event_type is null or user_id is null or product_id is null then 'mandatory_key'
    when not coalesce(length(user_session) >= 10, false) then 'session'
    when t is null then 'unparsable_time'
    when t not between timestamp '2024-01-01 00:00:00' and timestamp '2024-01-30 23:59:59' then 'outside_window'
    else 'valid' end as reason
  from timed)"""

NORMAL = """normal as (
  select date_trunc('second', t) as event_time, event_type, product_id,
         coalesce(nullif(regexp_replace(category_id, '\\.0$', ''), ''), '0') as category_id,
         coalesce(nullif(trim(lower(category_code)), ''), 'unknown') as category_code,
         coalesce(nullif(trim(lower(brand)), ''), 'unknown') as brand,
         price, user_id, user_session, source_file, batch
  from judged where reason = 'valid')"""


REPORT_RATES = (
    "completeness_score", "null_rate_event_time", "null_rate_event_type", "null_rate_product_id", "null_rate_user_id",
    "valid_event_types_rate", "price_valid_rate", "price_outlier_rate", "session_valid_rate", "valid_date_rate", "duplicate_rate",
)


def _quality(keys: str, extra: str = "") -> str:
    """Quality report per ``keys``; ``extra`` adds key columns to the raw rows."""
    share = lambda condition: f"avg(case when {condition} then 1e0 else 0e0 end)"
    null_rate = {c: share(f"{c} is null") for c in ("event_time", "event_type", "product_id", "user_id")}
    nulls = " + ".join(f"null_rate_{c}" for c in null_rate)
    gate = " and ".join(f"null_rate_{c} <= 0.05e0" for c in null_rate)
    rates = [
        "completeness_score", *[f"null_rate_{c}" for c in null_rate], "valid_event_types_rate", "price_valid_rate",
        "price_outlier_rate", "session_valid_rate", "valid_date_rate", "duplicate_rate",
    ]
    return f"""with {RAW_VIEW}, timed as (
  select *{extra}, try_cast(replace(event_time, ' UTC', '') as timestamp) as t from raw),
limits as (
  select {keys}, quantile_cont(price, 0.99) as q99 from timed where price is not null and not isnan(price) group by {keys}),
copies as (
  select {keys}, cast(sum(c - 1) as bigint) as duplicate_count from (
    select {keys}, count(*) as c from timed group by {keys}, {RAW_COLUMNS}) g group by {keys}),
sums as (
  select r.{keys}, count(*) as total_records,
         {', '.join(f'{expr.replace(c + " is", "r." + c + " is")} as null_rate_{c}' for c, expr in null_rate.items())},
         {share(f'coalesce(r.event_type in {EVENT_TYPES}, false)')} as valid_event_types_rate,
         {share('coalesce(price >= 0.01e0 and not isnan(price), false)')} as price_valid_rate,
         {share('coalesce(price > q99 and not isnan(price), false)')} as price_outlier_rate,
         {share('coalesce(length(user_session) >= 10, false)')} as session_valid_rate,
         {share("coalesce(t >= timestamp '2024-01-01 00:00:00' and t < timestamp '2024-01-31 00:00:00', false)")} as valid_date_rate
  from timed r left join limits l on l.{keys} = r.{keys} group by r.{keys}),
report as (
  select s.*, duplicate_count, cast(duplicate_count as double) / total_records as duplicate_rate,
         1e0 - ({nulls}) / 4e0 as completeness_score,
         {gate} and valid_event_types_rate >= 0.95e0 and price_valid_rate >= 0.95e0
           and session_valid_rate >= 0.9e0 and valid_date_rate >= 0.95e0 as passed_gate
  from sums s join copies c on c.{keys} = s.{keys})
select {keys}, total_records, passed_gate, {', '.join(f'{rounded(r, 4)} as {r}' for r in rates)}, duplicate_count
from report"""


# Load log of the hourly batches, under the name ``run_log``.
RUN_LOG = f"""{JUDGED}, {NORMAL}, kept as (
  select source_file, batch, count(*) as n from (select distinct * from normal) d group by source_file, batch),
batches as (
  select source_file, batch, count(*) as rows_read, count(*) filter (where reason = 'valid') as valid_rows,
         avg(case when event_time is null then 1e0 else 0e0 end) as n1,
         avg(case when event_type is null then 1e0 else 0e0 end) as n2,
         avg(case when product_id is null then 1e0 else 0e0 end) as n3,
         avg(case when user_id is null then 1e0 else 0e0 end) as n4,
         avg(case when event_type in {EVENT_TYPES} then 1e0 else 0e0 end) as types,
         avg(case when price >= 0.01e0 and not isnan(price) then 1e0 else 0e0 end) as prices,
         avg(case when length(user_session) >= 10 then 1e0 else 0e0 end) as sessions,
         avg(case when t >= timestamp '2024-01-01 00:00:00' and t < timestamp '2024-01-31 00:00:00' then 1e0 else 0e0 end) as dates
  from judged group by source_file, batch),
run_log as (
  select b.source_file, b.batch as id, rows_read, coalesce(k.n, 0) as rows_inserted,
         valid_rows - coalesce(k.n, 0) as duplicates_removed, rows_read - valid_rows as rows_rejected,
         {rounded('1e0 - (n1 + n2 + n3 + n4) / 4e0', 4)} as completeness_score,
         {rounded('sessions', 4)} as valid_sessions_rate,
         case when coalesce(k.n, 0) = 0 then 'FAILED'
              when n1 <= 0.05e0 and n2 <= 0.05e0 and n3 <= 0.05e0 and n4 <= 0.05e0 and types >= 0.6e0
               and prices >= 0.95e0 and sessions >= 0.9e0 and dates >= 0.95e0 then 'SUCCESS'
              else 'QUALITY_WARNING' end as status
  from batches b left join kept k on k.source_file = b.source_file and k.batch = b.batch)"""


def _features(span: str, observed: str) -> str:
    """``bounds`` with the cutoff and ``feat`` with features and label of users with observed events."""
    return f"""bounds as (select max(event_time) - {span} as cutoff from ev),
agg as (
  select user_id,
         min(event_time) filter (where {observed}) as first_seen, max(event_time) filter (where {observed}) as last_seen,
         max(event_time) as last_event,
         count(*) filter (where {observed}) as total_events,
         coalesce(cast(sum(cast(price as decimal(18,2))) filter (where {observed} and event_type = 'purchase') as double), 0e0) as total_spent,
         count(distinct product_id) filter (where {observed}) as unique_products,
         count(distinct category_level1) filter (where {observed}) as unique_categories,
         count(*) filter (where {observed} and event_type = 'view') as total_views,
         count(*) filter (where {observed} and event_type = 'purchase') as total_purchases
  from ev, bounds group by user_id),
feat as (
  select *, total_events / cast(days_active as double) as events_per_day, total_spent / total_events as spend_per_event,
         cast(total_purchases as double) / total_events as purchase_rate,
         case when last_event >= cutoff then 0 else 1 end as churned
  from (select *, case when total_purchases > 0 then total_spent / total_purchases else 0e0 end as avg_spent,
               greatest((epoch_us(last_seen) - epoch_us(first_seen)) // 86400000000 + 1, 1) as days_active
        from agg where total_events > 0) a, bounds)"""


FAVOURITE = """favourite as (
  select user_id, category_level1 as favorite_category from (
    select user_id, category_level1,
           row_number() over (partition by user_id order by count(*) desc, category_level1) as r
    from ev where category_level1 <> 'unknown' group by user_id, category_level1) c where r = 1)"""

FEATURES = """user_id, strftime(first_seen, '%Y-%m-%d %H:%M:%S') as first_interaction,
       strftime(last_seen, '%Y-%m-%d %H:%M:%S') as last_interaction, total_events, total_spent, avg_spent,
       unique_products, unique_categories, total_views, total_purchases, days_active, events_per_day,
       spend_per_event, purchase_rate"""
LABELLED = f"{FEATURES}, churned, '{{mode}}' as feature_mode, strftime(cutoff, '%Y-%m-%d %H:%M:%S') as label_cutoff"

SERVING = f"""{BEH}, {_features(DAY, 'true')}, {FAVOURITE}, serving as (
  select f.*, coalesce(v.favorite_category, 'electronics') as favorite_category
  from feat f left join favourite v on v.user_id = f.user_id)"""

TOP_PRODUCTS = f"""popular as (
  select category_level1, product_id,
         arg_max(category_code, (event_time, category_code)) as category_code, arg_max(brand, (event_time, brand)) as brand,
         {rounded(money('price') + ' / count(*)', 2)} as price, count(*) as popularity
  from ev where event_type = 'purchase' and category_level1 <> 'unknown' group by category_level1, product_id),
top_products as (
  select * from (select *, row_number() over (partition by category_level1 order by popularity desc, product_id) as rank
                 from popular) p where rank <= 10)"""

REQUESTS = """requests as (
  select o_orderkey as position,
         case when o_orderstatus = 'P' then 'c-' || cast(o_custkey as varchar) else cast(o_custkey as varchar) end as requested_id
  from orders),
asked as (
  select *, case when regexp_matches(requested_id, '^[0-9]{1,18}$') and try_cast(requested_id as bigint) > 0
                 then try_cast(requested_id as bigint) end as user_id from requests)"""

PROFILES = f"""profiles as (
  select user_id, strftime(first_seen, '%Y-%m-%d %H:%M:%S') as first_interaction,
         strftime(last_seen, '%Y-%m-%d %H:%M:%S') as last_interaction, days_active, total_events, total_purchases,
         {rounded('total_spent', 2)} as total_spent_usd, printf('%.1f%%', purchase_rate * 100e0) as purchase_rate,
         favorite_category
  from serving)"""

# Churn label of every user with a score that needs no model.
SCORED = f"""{ORD}, {_features(HALF_YEAR, 'event_time < cutoff')}, scored as (
  select user_id, churned as label, 1e0 - purchase_rate as score,
         case when 1e0 - purchase_rate >= 0.5e0 then 1 else 0 end as prediction from feat)"""

CONFUSION = """confusion as (
  select cast(count(*) filter (where label = 1 and prediction = 1) as double) as tp,
         cast(count(*) filter (where label = 0 and prediction = 1) as double) as fp,
         cast(count(*) filter (where label = 1 and prediction = 0) as double) as fn,
         cast(count(*) filter (where label = 0 and prediction = 0) as double) as tn, count(*) as n from scored)"""

SAMPLE_HASH = "((user_id % 2147483647) * 1103515245 + 42) % 2147483647"
CLOCK = "strftime({0}, '%Y-%m-%d %H:%M:%S') as {0}"
LATEST = "arg_max({0}, (event_time, {0})) as {0}"

DIM_BRAND = """by_category as (
  select brand, category_level1, count(*) as n, count(*) filter (where event_type = 'purchase') as purchases
  from ev group by brand, category_level1),
brands as (
  select brand, cast(sum(purchases) as bigint) as purchases from by_category group by brand),
dim_brand as (
  select dense_rank() over (order by b.brand) as brand_key, b.brand as brand_name, c.category_level1 as brand_category,
         b.purchases >= (select min(purchases) from (select purchases from brands order by purchases desc limit 3) t) as is_popular
  from brands b join (
    select brand, category_level1, row_number() over (partition by brand order by purchases desc, n desc, category_level1) as r
    from by_category) c on c.brand = b.brand and c.r = 1)"""


# The same under the narrow window of two of the queries.
def _narrow(text: str) -> str:
    return (
        text.replace("2024-01-01 00:00:00", "2024-01-03 00:00:00")
        .replace("2024-01-30 23:59:59", "2024-01-27 23:59:59").replace("2024-01-31 00:00:00", "2024-01-28 00:00:00")
    )


SERVING_ORDERS = SERVING.replace(BEH, ORD).replace(DAY, HALF_YEAR)

MODELS = """registry as (
  select case when o_custkey % 2 = 0 then 'customer_segmentation_kmeans' else 'churn_prediction_rf' end as model_name,
         strftime(o_orderdate, '%Y%m%d') as version, count(*) as training_samples,
         any_value(case when day(o_orderdate) % 5 = 4 then '1.0' when day(o_orderdate) % 7 <> 6 then '2.0' end) as feature_schema_version
  from orders group by 1, 2),
latest_models as (
  select * from registry r where version = (select max(version) from registry o where o.model_name = r.model_name)),
model_states as (
  select model_name, true as registered, coalesce(feature_schema_version = '2.0', false) as schema_current from latest_models)"""

DRIVERS = """concat_ws('; ',
  case when days_active <= 2 then 'Short engagement span (< 3 days)' end,
  case when purchase_rate = 0 then 'Zero conversions (views only)' end,
  case when events_per_day < 2 then 'Low interaction frequency' end)"""


def statements() -> dict[str, str]:
    scaled = ", ".join(
        f"round(({c} - avg({c}) over ()) / stddev_samp({c}) over (), 6) as scaled_{c}"
        for c in ("total_events", "total_spent", "avg_spent", "unique_products", "events_per_day")
    )
    clustering = "total_events, total_spent, avg_spent, unique_products, events_per_day"
    unrounded = ", ".join(f"({c} - avg({c}) over ()) / stddev_samp({c}) over () as scaled_{c}" for c in clustering.split(", "))
    squares = " + ".join(f"(a.scaled_{c} - b.scaled_{c}) ** 2" for c in clustering.split(", "))
    levels = "category_level1, category_level2, category_level3"
    return {
        "clean_events": f"""with {JUDGED}, {NORMAL}, kept as (select distinct * exclude (batch) from normal)
select {CLOCK.format('event_time')}, event_type, product_id, category_id, category_code, brand, price, user_id, user_session,
       cast(cast(event_time as date) as varchar) as date, hour(event_time) as hour, isodow(event_time) - 1 as day_of_week,
       dayname(event_time) as day_name, month(event_time) as month, year(event_time) as year,
       {_parts('category_code')}, source_file from kept""",
        "distinct_raw_rows": f"""with {RAW_VIEW} select source_file, count(*) as distinct_rows
from (select distinct * from raw) d group by source_file""",
        "reject_reasons": f"with {JUDGED} select source_file, reason, count(*) as rows from judged group by source_file, reason",
        "quality_report": _quality("source", ", 'events' as source"),
        "quality_by_type": _quality("event_type"),
        "quality_by_source": _quality("source_file"),
        "duplicate_rows": f"""with {RAW_VIEW} select source_file, cast(sum(c) as bigint) as total_records,
       cast(sum(c - 1) as bigint) as duplicate_count
from (select source_file, count(*) as c from raw group by source_file, {RAW_COLUMNS}) g group by source_file""",
        "user_features": f"with {BEH}, {_features(DAY, 'true')} select {LABELLED.format(mode='descriptive')} from feat",
        "user_features_pre_cutoff": f"""with {ORD}, {_features(HALF_YEAR, 'event_time < cutoff')}
select {LABELLED.format(mode='held_out')} from feat""",
        "serving_features": f"with {SERVING} select {FEATURES}, favorite_category from serving",
        "churn_labels": f"with {ORD}, {_features(HALF_YEAR, 'event_time < cutoff')} select user_id, churned from feat",
        "churn_labels_daily": f"with {BEH}, {_features(DAY, 'event_time < cutoff')} select user_id, churned from feat",
        "user_sample": f"""with {ORD}, selected as (
  select user_id from ev group by user_id order by {SAMPLE_HASH}, user_id limit 500)
select user_id, count(*) as events from ev where user_id in (select user_id from selected) group by user_id""",
        "favourite_category": f"with {BEH}, {FAVOURITE} select user_id, favorite_category from favourite",
        "top_spenders": f"""with {ORD} select user_id, count(*) as event_count,
       {money("case when event_type = 'purchase' then price end")} as total_spent
from ev group by user_id having count(*) > 5 order by total_spent desc, user_id limit 5""",
        "distinct_users": f"with {ORD} select distinct user_id from ev order by user_id limit 10",
        "first_purchaser": f"with {ORD} select distinct user_id from ev where event_type = 'purchase' order by user_id limit 1",
        "events_preview": f"""with {BEH}, head as (select * from ev order by event_time, user_id, product_id limit 5)
select {CLOCK.format('event_time')}, event_type, product_id, category_id, category_code, brand, price, user_id, user_session,
       cast(cast(event_time as date) as varchar) as date, hour(event_time) as hour, isodow(event_time) - 1 as day_of_week,
       dayname(event_time) as day_name, month(event_time) as month, year(event_time) as year, {levels},
       'events' as source_file from head""",
        "category_top_products": f"with {BEH}, {TOP_PRODUCTS} select * from top_products",
        "user_recommendations": f"""with {SERVING}, {TOP_PRODUCTS}, candidates as (
  select s.user_id, s.favorite_category, t.*,
         row_number() over (partition by s.user_id order by case when t.category_level1 = s.favorite_category then 0 else 1 end,
                            t.popularity desc, t.product_id, t.category_level1) as place
  from serving s cross join top_products t)
select user_id, favorite_category, place as rank, product_id, category_level1 as category,
       coalesce(nullif(brand, ''), 'General') as brand, price as price_usd, popularity as popularity_score,
       'Top trending in ''' || category_level1 || ''' category' as recommendation_reason
from candidates where place <= 5""",
        "requested_profiles": f"""with {SERVING}, {PROFILES}, {REQUESTS}
select a.position, a.requested_id,
       case when a.user_id is null then 'INVALID' when p.user_id is null then 'NOT_FOUND' else 'SUCCESS' end as status,
       case when a.user_id is not null and p.user_id is null
            then 'User ' || a.requested_id || ' has no records in the event store.' end as message,
       a.user_id, p.* exclude (user_id)
from asked a left join profiles p on p.user_id = a.user_id""",
        "not_found_users": f"""with {BEH}, {REQUESTS} select position, user_id from asked
where user_id is not null and user_id not in (select user_id from ev)""",
        "risk_bands": f"""with {SCORED}, banded as (
  select user_id, case when score >= 0.7e0 then 'HIGH' when score >= 0.4e0 then 'MEDIUM' else 'LOW' end as risk_level from scored)
select *, case risk_level when 'HIGH' then 'Urgent win-back promotion, discount offer via notification'
               when 'MEDIUM' then 'Personalized engagement email and featured product digest'
               else 'Standard loyalty program engagement' end as suggested_action from banded""",
        "risk_drivers": f"""with {SERVING} select user_id, concat_ws('; ',
  case when days_active <= 2 then 'Short engagement span (< 3 days)' end,
  case when purchase_rate = 0 then 'Zero conversions (views only)' end,
  case when events_per_day < 2 then 'Low interaction frequency' end) as risk_drivers from serving""",
        "threshold_metrics": f"""with {SCORED}, {CONFUSION}
select (tp + tn) / n as accuracy, case when tp + fp > 0 then tp / (tp + fp) else 0e0 end as precision,
       case when tp + fn > 0 then tp / (tp + fn) else 0e0 end as recall,
       case when tp + fp + fn > 0 then tp * 2 / (tp * 2 + fp + fn) else 0e0 end as f1,
       (case when tp + fn > 0 then tp / (tp + fn) else 0e0 end + case when tn + fp > 0 then tn / (tn + fp) else 0e0 end) / 2e0
         as balanced_accuracy from confusion""",
        "ranking_metrics": f"""with {SCORED}, by_score as (
  select score, count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg from scored group by score),
ranked as (
  select *, sum(pos) over (order by score desc) as hits, sum(neg) over (order by score desc) as misses from by_score)
select round(sum(cast(pos as double) * (cast(hits as double) / cast(hits + misses as double))) / cast(sum(pos) as double), 9)
         as average_precision,
       round(sum(cast(neg as double) * (cast(hits - pos as double) + pos / 2e0)) / (cast(sum(pos) as double) * cast(sum(neg) as double)), 9)
         as roc_auc from ranked""",
        "majority_baseline": f"""with {SCORED}, split as (select *, {SAMPLE_HASH} < 429496729 as is_test from scored),
counts as (
  select case when count(*) filter (where not is_test and label = 1) > count(*) filter (where not is_test and label = 0)
              then 1 else 0 end as guess,
         cast(count(*) filter (where is_test and label = 1) as double) as pos,
         cast(count(*) filter (where is_test and label = 0) as double) as neg from split)
select guess as baseline_label, case when guess = 1 then pos / (pos + neg) else neg / (pos + neg) end as baseline_accuracy,
       case when guess = 1 and pos + neg > 0 then pos * 2 / (pos * 2 + neg) else 0e0 end as baseline_f1 from counts""",
        "stratified_split": f"""with {SCORED}, placed as (
  select user_id, label, row_number() over (partition by label order by {SAMPLE_HASH}, user_id) as place,
         count(*) over (partition by label) as n from scored)
select user_id, label as churned, place <= floor(n * 0.2e0 + 0.5e0) as is_test from placed""",
        "scaled_features": f"with {SERVING_ORDERS} select user_id, {scaled} from serving",
        "user_segments": f"""with {SERVING_ORDERS} select user_id, true as segment_exists, true as persona_fits, 5 as segments
from serving""",
        "churn_scores": f"""with {SERVING_ORDERS} select user_id, true as in_range, true as band_follows, true as action_follows,
       true as label_follows, {DRIVERS} as risk_drivers from serving""",
        "feature_importance": "select 9 as features, true as not_negative, true as sum_to_one, true as shares_of_gain",
        "segment_agreement": f"with {SERVING_ORDERS} select user_id, true as nearest_centre from serving",
        "churn_agreement": f"with {SERVING_ORDERS} select user_id, true as mean_of_trees from serving",
        "churn_evaluation": f"""with {ORD}, {_features(HALF_YEAR, 'event_time < cutoff')}, placed as (
  select user_id, churned, row_number() over (partition by churned order by {SAMPLE_HASH}, user_id) as place,
         count(*) over (partition by churned) as n from feat),
split as (select churned, place <= floor(n * 0.2e0 + 0.5e0) as is_test from placed),
counts as (
  select count(*) filter (where is_test) as test_users, count(*) filter (where is_test and churned = 1) as churned,
         case when count(*) filter (where not is_test and churned = 1) > count(*) filter (where not is_test and churned = 0) then 1 else 0 end
           as baseline_label from split)
select *, cast(case when baseline_label = 1 then churned else test_users - churned end as double) / test_users as baseline_accuracy,
       case when baseline_label = 1 then cast(churned * 2 as double) / (churned + test_users) else 0e0 end as baseline_f1,
       true as metrics_follow from counts""",
        "high_risk_users": "select true as only_high, true as all_high",
        "campaign_scores": f"""with {SERVING_ORDERS}, {REQUESTS}
select a.position, a.requested_id,
       case when a.user_id is null then 'INVALID' when s.user_id is null then 'NOT_FOUND' else 'SUCCESS' end as status,
       a.user_id, s.days_active, s.total_spent, case when s.user_id is not null then true end as scored
from asked a left join serving s on s.user_id = a.user_id""",
        "customer_360": f"""with {SERVING_ORDERS}, {PROFILES}, {TOP_PRODUCTS}, candidates as (
  select s.user_id, t.product_id,
         row_number() over (partition by s.user_id order by case when t.category_level1 = s.favorite_category then 0 else 1 end,
                            t.popularity desc, t.product_id, t.category_level1) as place
  from serving s cross join top_products t),
lists as (
  select user_id, string_agg(cast(product_id as varchar), ',' order by place) as recommended
  from candidates where place <= 5 group by user_id)
select p.*, recommended, true as risk_sound, true as segment_sound from profiles p join lists l on l.user_id = p.user_id""",
        "segment_personas": f"""with {ORD}, {_features(HALF_YEAR, 'true')}, summary as (
  select least(total_purchases // 10, 4) as cluster, count(*) as users, {rounded('avg(total_spent)', 2)} as total_spent,
         {rounded('avg(total_events)', 2)} as total_events, {rounded('avg(events_per_day)', 2)} as events_per_day
  from feat group by 1)
select *, printf('Segment %d: avg purchases $%.2f, %.0f events', cluster, total_spent, total_events) as persona_name,
       case when total_spent > 0 then 'Retention and relevant product recommendations'
            else 'Product discovery and first-purchase offers' end as marketing_strategy from summary""",
        "decisions_for_sources": f"""with {RAW_VIEW}, listing as (
  select source_file, cast(count(*) filter (where event_type = 'purchase') as varchar) as fingerprint from raw group by source_file),
manifest as (
  select source_file, count(*) filter (where event_type = 'purchase') as rows_loaded,
         case when source_file > 'events-2024-01-15.csv' then 200000 end as row_limit
  from (select distinct source_file, {RAW_COLUMNS} from raw) d group by source_file)
select l.source_file, l.fingerprint,
       case when l.fingerprint <> cast(m.rows_loaded as varchar) then 'LOAD'
            when m.row_limit is null then 'SKIP' when 100000 < m.row_limit then 'REFUSE' else 'LOAD' end as decision,
       m.rows_loaded
from listing l join manifest m on m.source_file = l.source_file""",
        "reject_reasons_narrow": f"""with {_narrow(JUDGED)} select source_file, reason, count(*) as rows
from judged group by source_file, reason""",
        "latest_status_narrow": f"""with {_narrow(RUN_LOG)} select * from run_log r
where id in (select max(id) from run_log group by source_file)""",
        "alerts_narrow": f"""with {_narrow(RUN_LOG)}, {MODELS}, latest as (
  select source_file, status from run_log where id in (select max(id) from run_log group by source_file))
select 'HIGH' as severity, 'ModelSchema' as component, 'Models need retraining for the current feature schema.' as message
where (select bool_or(not schema_current) from model_states)
union all select case status when 'FAILED' then 'HIGH' else 'WARNING' end,
       case status when 'FAILED' then 'ETLPipeline' else 'DataQualityGate' end,
       source_file || ': ' || status || '. Inspect raw quality reports; invalid rows are excluded during cleaning.'
from latest where status in ('FAILED', 'QUALITY_WARNING')""",
        "model_status": f"with {MODELS} select * from model_states",
        "registry_summary": f"with {MODELS} select *, (select count(*) from registry) as versions from latest_models",
        "load_guard": f"""with {MODELS}, wanted as (
  select y || d as as_of, m as model_name from (select unnest(range(1994, 2002))::varchar as y) a
  cross join (select unnest(['0605', '0714']) as d) b
  cross join (select unnest(['customer_segmentation_kmeans', 'churn_prediction_rf', 'price_forecast']) as m) c),
newest as (
  select as_of, w.model_name, max(r.version) as version from wanted w
  left join registry r on r.model_name = w.model_name and r.version <= as_of group by 1, 2)
select as_of, n.model_name, n.version, case when n.version is null then 'MISSING' when feature_schema_version = '2.0' then 'LOADABLE'
       else 'STALE' end as verdict
from newest n left join registry r on r.model_name = n.model_name and r.version = n.version""",
        "segment_silhouette": f"""with {ORD}, {_features(HALF_YEAR, 'true')}, scaled as (
  select user_id, least(total_purchases // 10, 4) as cluster, {unrounded} from feat),
points as (
  select * from scaled order by {SAMPLE_HASH}, user_id limit 5000),
distances as (
  select a.user_id, a.cluster, b.cluster as other, sum(sqrt(d2)) as linear, sum(d2) as squared, count(*) as n
  from points a cross join points b, lateral (select {squares} as d2) d group by 1, 2, 3),
per_point as (
  select user_id, cluster, max(case when other = cluster and n > 1 then linear / (n - 1) end) as a1,
         min(case when other <> cluster then linear / n end) as b1,
         max(case when other = cluster and n > 1 then squared / (n - 1) end) as a2,
         min(case when other <> cluster then squared / n end) as b2
  from distances group by 1, 2),
scored as (
  select cluster, coalesce((b1 - a1) / nullif(greatest(a1, b1), 0), 0) as s1,
         coalesce((b2 - a2) / nullif(greatest(a2, b2), 0), 0) as s2 from per_point)
select cluster, count(*) as users, round(avg(s1), 6) as silhouette_euclidean, round(avg(s2), 6) as silhouette_squared
from scored group by rollup (cluster)""",
        "source_replacement": f"""with {JUDGED}, {NORMAL}, thirds as (
  select 'third-' || cast(user_id % 3 as varchar) || '.csv' as source_file,
         count(distinct case when batch % 2 = 0 then (event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session) end) as half,
         count(distinct (event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session)) as whole
  from normal group by 1)
select source_file, 1 as attempt, case source_file when 'third-0.csv' then 'SUPERSEDED' else 'CURRENT' end as state, half as rows,
       case source_file when 'third-0.csv' then whole else half end as visible_rows,
       'QUALITY_WARNING,' || case source_file when 'third-0.csv' then 'QUALITY_WARNING' else 'FAILED' end as runs from thirds
union all
select source_file, 2, case source_file when 'third-0.csv' then 'CURRENT' else 'ORPHAN' end, whole,
       case source_file when 'third-0.csv' then whole else half end,
       'QUALITY_WARNING,' || case source_file when 'third-0.csv' then 'QUALITY_WARNING' else 'FAILED' end
from thirds where source_file <> 'third-1.csv'""",
        "csv_round_trip": f"""with {RAW_VIEW} select event_time, event_type, product_id, category_id,
       case when product_id % 7 <> 2 then category_code end as category_code,
       case when product_id % 5 = 1 then 'say "' || brand || '",' || chr(13) || chr(10) || chr(10) || 'then, more' else brand end as brand,
       case when not isnan(price) then price end as price, user_id, user_session from raw""",
        "bounded_load": "select event_id, event_type, user_id, value from events order by event_id limit 600",
        "json_documents": f"""with {RAW_VIEW} select {RAW_COLUMNS.replace(', price', '')}, case when not isnan(price) then price end as price
from raw""",
        "report_trend": f"""with reports as ({_quality("batch").replace("valid_event_types_rate >= 0.95e0", "valid_event_types_rate >= 0.6e0")})
select batch as id, 'day-' || cast(batch // 24 as varchar) as source_file,
       case when passed_gate then 'PASSED' else 'FAILED' end as status, * exclude (batch),
       {', '.join(f"{rounded(f'{r} - lag({r}) over w', 4)} as {r}_change" for r in REPORT_RATES)},
       passed_gate <> lag(passed_gate) over w as gate_turned
from reports window w as (partition by batch // 24 order by batch)""",
        "clean_gate": f"""with {RUN_LOG}, gates as (
  select source_file, batch, avg(case when price >= 2 then 1e0 else 0e0 end) >= 0.95e0 as clean
  from (select distinct * from normal) d group by 1, 2)
select r.source_file, id as batch, rows_read, case when clean then rows_inserted else 0 end as rows_committed,
       case when clean then status else 'FAILED' end as status,
       case when rows_inserted = 0 then 'no valid event, the last load stays current'
            when not clean then 'the cleaned rows miss the quality gate' end as refusal
from run_log r left join gates g on g.source_file = r.source_file and g.batch = r.id""",
        "training_readiness": f"""with {ORD}, {_features(HALF_YEAR, 'event_time < cutoff')}, cohorts as (
  select strftime(first_seen, '%Y-%m') as cohort, count(*) as users, count(distinct ({clustering})) as vectors,
         count(*) filter (where churned = 1) as churned, count(*) filter (where churned = 0) as retained from feat group by 1)
select *, case when users <= 5 then 'not more users than segments'
               when vectors < 5 then 'fewer distinct feature vectors than segments' end as segment_refusal,
       case when users < 10 then 'fewer than ten users'
            when least(churned, retained) < 2 then 'fewer than two users of a class' end as churn_refusal
from cohorts""",
        "snapshot_states": f"""with {BEH}, dated as (select *, cast(event_time as date) as d from ev),
days as (select unnest([date '2024-01-10', date '2024-01-11', date '2024-01-12', date '2024-01-13']) as day),
held as (
  select day, dated.* from days join dated on d <= day and not (user_id % 7 = 3 and d < day - 2)),
gained as (
  select day, event_type, count(*) as added from held where d = day and day > date '2024-01-10' group by 1, 2),
lost as (
  select h.day + 1 as day, event_type, count(*) as withdrawn from held h
  where user_id % 7 = 3 and d = h.day - 2 and h.day < date '2024-01-13' group by 1, 2)
select strftime(h.day, '%Y%m%d') as snapshot_date, h.event_type, count(*) as events, count(distinct user_id) as users,
       cast(sum(product_id) as bigint) as products, coalesce(any_value(added), 0) as added, coalesce(any_value(withdrawn), 0) as withdrawn
from held h left join gained g on g.day = h.day and g.event_type = h.event_type
left join lost l on l.day = h.day and l.event_type = h.event_type group by 1, 2""",
        "health_document": f"""with {BEH}, {_narrow(RUN_LOG)}, {MODELS}, counts as (
  select 'absent' as table_name, 0 as row_count union all select 'events', (select count(*) from ev)
  union all select 'model_performance', (select count(*) from registry)
  union all select 'pipeline_metadata', (select count(*) from run_log)),
latest as (
  select source_file, status from run_log where id in (select max(id) from run_log group by source_file)),
found as (
  select 'HIGH' as severity, 'ModelSchema' as component, 'Models need retraining for the current feature schema.' as message
  where (select bool_or(not schema_current) from model_states)
  union all select case status when 'FAILED' then 'HIGH' else 'WARNING' end,
       case status when 'FAILED' then 'ETLPipeline' else 'DataQualityGate' end,
       source_file || ': ' || status || '. Inspect raw quality reports; invalid rows are excluded during cleaning.'
  from latest where status in ('FAILED', 'QUALITY_WARNING'))
select '2024-02-01T00:00:00Z' as checked_at,
       cast(to_json(struct_pack(tables := (select list(c order by table_name) from counts c),
                                models := (select list(m order by model_name) from model_states m))) as varchar) as health,
       cast(to_json(coalesce((select list(f order by severity, component, message) from found f), [])) as varchar) as alerts""",
        "quality_history": f"""select batch as id, total_records, completeness_score, session_valid_rate as valid_sessions_rate,
       case when passed_gate then 'PASSED' else 'FAILED' end as status
from ({_quality("batch").replace("valid_event_types_rate >= 0.95e0", "valid_event_types_rate >= 0.6e0")}) r
order by id desc limit 20""",
        "latency": f"with {RUN_LOG} select id, source_file, status, rows_read / 1e3 as execution_seconds from run_log",
        "typed_dirty_columns": f"""with {RAW_VIEW}, garbled as (
  select * exclude (price), case when product_id % 6 <> 1 then price end as price from raw),
judged as (
  select *, try_cast(replace(event_time, ' UTC', '') as timestamp) as t, 'valid' as reason from garbled
  where price > 0 and not isnan(price) and event_type in {EVENT_TYPES} and user_id is not null
    and length(user_session) >= 10),
{NORMAL}
select distinct {CLOCK.format('event_time')}, event_type, product_id, category_id, brand, price, user_id, user_session
from normal where event_time between timestamp '2024-01-01 00:00:00' and timestamp '2024-01-30 23:59:59'""",
        "latest_status": f"""with {RUN_LOG} select * from run_log r
where id in (select max(id) from run_log group by source_file)""",
        "alerts": f"""with {RUN_LOG}, latest as (
  select source_file, status from run_log where id in (select max(id) from run_log group by source_file))
select 'HIGH' as severity, 'ModelRegistry' as component,
       'Missing trained model artifacts: churn_prediction_rf, customer_segmentation_kmeans' as message
union all select 'HIGH', 'ModelSchema', 'Models need retraining for the current feature schema.'
union all select case status when 'FAILED' then 'HIGH' else 'WARNING' end,
       case status when 'FAILED' then 'ETLPipeline' else 'DataQualityGate' end,
       source_file || ': ' || status || '. Inspect raw quality reports; invalid rows are excluded during cleaning.'
from latest where status in ('FAILED', 'QUALITY_WARNING')""",
        "run_history": f"with {RUN_LOG} select * from run_log order by id desc limit 20",
        "quality_trend": f"""with {RUN_LOG} select id, source_file, completeness_score * 100e0 as completeness_percent,
       valid_sessions_rate * 100e0 as valid_sessions_percent, 95e0 as minimum_percent from run_log""",
        "table_counts": f"""with {BEH}, {RAW_VIEW}
select 'raw_events' as table_name, count(*) as row_count from raw
union all select 'events', count(*) from ev
union all select 'pipeline_metadata', count(*) from (select distinct source_file, batch from raw) b
union all select 'user_features', count(distinct user_id) from ev
union all select 'model_performance', 0""",
        "dim_users": f"""with {BEH} select user_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') as first_seen,
       strftime(max(event_time), '%Y-%m-%d %H:%M:%S') as last_seen, count(distinct user_session) as total_sessions,
       count(*) filter (where event_type = 'purchase') as total_purchases,
       {rounded(money("case when event_type = 'purchase' then price end"), 2)} as total_spent from ev group by user_id""",
        "dim_products": f"""with {BEH}, products as (
  select product_id, {LATEST.format('category_id')}, {LATEST.format('category_code')}, {LATEST.format('brand')},
         {rounded(money('price') + ' / count(*)', 2)} as avg_price, min(price) as min_price, max(price) as max_price,
         count(*) filter (where event_type = 'view') as total_views, count(*) filter (where event_type = 'cart') as total_carts,
         count(*) filter (where event_type = 'purchase') as total_purchases from ev group by product_id)
select *, case when total_views > 0 then {rounded('cast(total_purchases * 100 as double) / total_views', 2)} end as conversion_rate
from products""",
        "dim_categories": f"""with {BEH}, categories as (
  select category_id, {LATEST.format('category_code')}, count(distinct product_id) as total_products,
         {rounded(money("case when event_type = 'purchase' then price end"), 2)} as total_revenue from ev group by category_id)
select category_id, category_code, list_extract(string_split(category_code, '.'), 1) as category_level1,
       list_extract(string_split(category_code, '.'), 2) as category_level2,
       list_extract(string_split(category_code, '.'), 3) as category_level3, total_products, total_revenue from categories""",
        "fact_events": f"""with {BEH} select {CLOCK.format('event_time')}, event_type, product_id, user_id, user_session, price,
       'events' as source_file from ev""",
        "dim_date": f"""with {ORD}, days as (
  select unnest(generate_series(min(date_trunc('day', event_time)), max(date_trunc('day', event_time)), interval 1 day)) as d from ev)
select cast(strftime(d, '%Y%m%d') as bigint) as date_key, cast(cast(d as date) as varchar) as full_date,
       dayofweek(d) + 1 as day_of_week, dayname(d) as day_name, month(d) as month, monthname(d) as month_name,
       quarter(d) as quarter, year(d) as year, dayofweek(d) in (0, 6) as is_weekend from days""",
        "dim_brand": f"with {BEH}, {DIM_BRAND} select * from dim_brand",
        "fact_sales_daily": f"""with {BEH}, {DIM_BRAND}
select cast(strftime(cast(event_time as date), '%Y%m%d') as bigint) as date_key, product_id as product_key, brand_key,
       category_id as category_key, count(*) filter (where event_type = 'view') as total_views,
       count(*) filter (where event_type = 'cart') as total_carts,
       count(*) filter (where event_type = 'purchase') as total_purchases,
       {rounded(money("case when event_type = 'purchase' then price end"), 2)} as total_revenue,
       count(distinct user_id) as unique_users
from ev join dim_brand on brand_name = brand group by 1, 2, 3, 4""",
        "price_iqr": f"""with {ORD}, quartiles as (
  select category_level1, quantile_cont(price, 0.25) as q1, quantile_cont(price, 0.75) as q3 from ev group by category_level1),
fences as (
  select *, q1 - (q3 - q1) * 1.5e0 as low_fence, q3 + (q3 - q1) * 1.5e0 as high_fence from quartiles)
select f.category_level1, q1, q3, low_fence, high_fence, count(*) as events,
       count(*) filter (where price < low_fence or price > high_fence) as outliers
from ev join fences f on f.category_level1 = ev.category_level1 group by 1, 2, 3, 4, 5""",
        "zero_sessions": f"""with {BEH} select user_session, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') as started,
       count(*) as events from ev group by user_session having min(event_time) = max(event_time)""",
    }
