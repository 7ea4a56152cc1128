"""For each registered query the same result in plain SQL over the test tables (DuckDB dialect)."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# ---- shared views -------------------------------------------------------------------------------

_ORDER_INFO = """
oi as (
  select o_orderkey id, o_custkey user_id, c_nationkey province_id, o_orderstatus order_status,
         cast(round(o_totalprice * 100) as bigint) final_cents,
         strftime(o_orderdate, '%Y-%m-%d') create_date,
         lpad(cast((o_orderkey * 7919) % 24 as varchar), 2, '0') create_hour
  from orders join customer on o_custkey = c_custkey)"""

_ALLOCATED = (
    _ORDER_INFO
    + """,
od as (
  select l_orderkey order_id,
         row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag,
           l_linestatus) line_no,
         cast(l_linenumber as bigint) * 1000000000000 + l_partkey order_detail_id,
         l_partkey sku_id, cast(l_quantity as bigint) sku_num,
         cast(round(l_extendedprice * 100) as bigint) detail_cents
  from lineitem),
w as (
  select od.*, user_id, province_id, final_cents, create_date dt, create_hour,
         cast(sum(detail_cents) over (partition by order_id) as bigint) original_cents,
         sum(detail_cents) over (partition by order_id order by line_no) reached
  from od join oi on oi.id = od.order_id),
p as (
  select *, case when original_cents = 0 then 0
                 else (2 * final_cents * detail_cents + original_cents) // (2 * original_cents) end prop,
         min(case when reached = original_cents then line_no end) over (partition by order_id) last_no
  from w),
a as (
  select *, cast(case when line_no = last_no
                 then final_cents - coalesce(sum(prop) over (partition by order_id order by line_no
                        rows between unbounded preceding and 1 preceding), 0)
                 else prop end as bigint) share_cents
  from p)"""
)

_USERS = """
people as (
  select c_custkey id, birthday, gender,
         case when age < 20 then '20 岁及以下' when age > 30 then '30 岁以上'
              else '21 岁到 30 岁' end age_group,
         case when gender = 'M' then '男' else '女' end gender_name
  from (select c_custkey, strftime(b, '%Y-%m-%d') birthday,
               case when c_custkey % 2 = 0 then 'M' else 'F' end gender,
               (date '2024-01-01' - b) // 365 age
        from (select c_custkey, date '1950-01-01' + cast(c_custkey * 37 % 20000 as int) b
              from customer) x) y)"""

_LOGS = """
logs as (
  select cast(user_id as varchar) mid, epoch_us(ts) // 1000 ts, strftime(ts, '%Y-%m-%d') dt,
         strftime(ts, '%H') hr, event_type ch
  from events),
firsts as (select mid, dt, min(hr) hr, min(ts) ts from logs group by mid, dt)"""

_RATING = """
rating as (
  select cast(uid as int) uid, cast(mid as int) mid, score, ts as "timestamp" from (
    select o_custkey uid, l_partkey mid, cast(ceil(l_quantity / 5) as double) / 2 score,
           cast(epoch(l_shipdate) as bigint) ts,
           row_number() over (partition by o_custkey, l_partkey
             order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_suppkey desc,
                      l_quantity desc, l_extendedprice desc) rn
    from lineitem join orders on l_orderkey = o_orderkey) x
  where rn = 1)"""

_MOVIE = """
movie as (
  select cast(p_partkey as int) mid, p_name as name,
         concat_ws('|', p_type, replace(p_name, ' ', '|')) genres
  from part)"""

_TAG = """
tag as (
  select cast(o_custkey as int) uid, cast(l_partkey as int) mid,
         concat(l_returnflag, '-', o_orderpriority) tag,
         cast(epoch(l_shipdate) as int) "timestamp"
  from lineitem join orders on l_orderkey = o_orderkey)"""

# word lists per item; distinct words per item; set cosine between items sharing a word
_SET_SIM = """
ws as (
  select distinct mid, unnest(string_split(lower(replace(genres, '|', ' ')), ' ')) word from movie),
size as (select mid, count(*) n from ws group by mid),
sim as (
  select * from (
    select a.mid, b.mid other_mid, round(count(*) / sqrt(any_value(sa.n) * any_value(sb.n)), 9) score
    from ws a join ws b on a.word = b.word and a.mid <> b.mid
         join size sa on sa.mid = a.mid join size sb on sb.mid = b.mid
    group by a.mid, b.mid) x
  where score > 0.6)"""

_RECENT = """
recent as (
  select * from (
    select uid, mid, score, "timestamp",
           row_number() over (partition by uid order by "timestamp" desc, mid desc) rank
    from rating) x
  where rank <= 20)"""

_UNSEEN = """
unseen as (
  select * from (
    select r.uid, r.mid, row_number() over (partition by r.uid order by s.score desc, s.other_mid) rank,
           s.other_mid candidate, s.score
    from recent r join sim s on s.mid = r.mid
    where r.rank = 1
      and not exists (select 1 from rating q where q.uid = r.uid and q.mid = s.other_mid)) x
  where rank <= 20)"""

_TFIDF = """
prof as (
  select mid, array_to_string(list_sort(string_split(lower(replace(genres, '|', ' ')), ' ')), ' ') profile
  from movie),
words as (select mid, profile, unnest(string_split(profile, ' ')) word from prof),
tf as (select mid, any_value(profile) profile, word, count(*) tf from words group by mid, word),
idf as (
  select word, ln(((select count(*) from prof) + 1) / (count(*) + 1)) idf from tf group by word),
one as (
  select distinct profile, word, tf * idf w from tf join idf using (word)
  where mid in (select min(mid) from prof group by profile)),
norm as (select profile, sqrt(sum(w * w)) n from one group by profile),
psim as (
  select * from (
    select a.profile, b.profile other_profile,
           round(sum(a.w * b.w) / (any_value(na.n) * any_value(nb.n)), 9) score
    from one a join one b on a.word = b.word and a.profile <> b.profile
         join norm na on na.profile = a.profile join norm nb on nb.profile = b.profile
    group by a.profile, b.profile) x
  where score > 0.6
  union all select profile, profile, 1.0 from norm where n > 0)"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


# ---- orders -------------------------------------------------------------------------------------

ORACLES["trademark_top_n"] = (
    _with(_ALLOCATED)
    + """
select x, floor(y / 100.0 * 100 + 0.5) / 100 y, 1 s
from (select p_brand x, cast(sum(share_cents) as bigint) y
      from a join part on sku_id = p_partkey
      where dt > '1996-01-01' and dt < '1998-01-01'
      group by p_brand
      order by y desc, cast(split_part(p_brand, '#', 2) as int) limit 5) t"""
)

ORACLES["order_wide_alloc"] = (
    _with(_ALLOCATED)
    + """
select order_id, order_detail_id, user_id, sku_num, detail_cents, original_cents, final_cents,
       share_cents
from a"""
)

ORACLES["order_wide_record"] = (
    _with(_ALLOCATED, _USERS)
    + """
, flag as (
  select id, row_number() over (partition by user_id order by create_date, create_hour, id) rn,
         order_status, concat(create_date, ' ', create_hour, ':00:00') create_time
  from oi)
select order_detail_id, order_id, order_status, create_time, user_id, sku_id,
       ((2 * detail_cents + sku_num) // (2 * nullif(sku_num, 0))) / 100 sku_price, sku_num, concat_ws(' ', p_type, p_name) sku_name,
       cast(0 as double) benefit_reduce_amount, cast(0 as double) feight_fee,
       original_cents / 100 original_total_amount, final_cents / 100 final_total_amount,
       share_cents / 100 final_detail_amount, case when rn = 1 then '1' else '0' end if_first_order,
       n_name province_name, concat('A', n_regionkey) province_area_code,
       age_group user_age_group, gender_name user_gender, dt, md5(p_name) spu_id,
       split_part(p_brand, '#', 2) tm_id, md5(p_type) category3_id, p_name spu_name,
       p_brand tm_name, p_type category3_name
from a join flag on flag.id = order_id join part on sku_id = p_partkey
     left join nation on province_id = n_nationkey left join people on user_id = people.id"""
)

ORACLES["order_amount_total"] = (
    _with(_ALLOCATED)
    + "select cast(coalesce(sum(share_cents), 0) as bigint) amount_cents from a where dt = '1998-03-02'"
)

ORACLES["order_amount_hourly"] = (
    _with(_ALLOCATED)
    + """
select create_hour hr, cast(sum(share_cents) as bigint) amount_cents from a
where dt = '1998-03-02' group by create_hour"""
)

ORACLES["realtime_hour_amount"] = (
    _with(_ALLOCATED)
    + """
select lpad(cast(h as varchar), 2, '0') hr,
       cast(coalesce(sum(case when dt = '1998-03-02' then share_cents end), 0) as bigint) today,
       cast(coalesce(sum(case when dt = '1998-03-01' then share_cents end), 0) as bigint) yesterday
from range(24) r(h) left join a on cast(create_hour as int) = h and dt in ('1998-03-01', '1998-03-02')
group by h"""
)

ORACLES["province_sales"] = (
    _with(_ALLOCATED)
    + """
select n_name province_name, cast(sum(share_cents) as bigint) amount_cents
from a left join nation on province_id = n_nationkey group by n_name"""
)

ORACLES["buyer_shares"] = (
    _with(_ORDER_INFO, _USERS)
    + """
, buyer as (
  select distinct user_id, age_group, gender_name from oi join people on user_id = people.id
  where create_date = '1998-03-02'),
c as (
  select 'age' kind, age_group "label", count(*) buyers from buyer group by age_group
  union all select 'gender', gender_name, count(*) from buyer group by gender_name)
select kind, "label", buyers, round(buyers / sum(buyers) over (partition by kind), 6) share from c"""
)

ORACLES["sale_detail"] = (
    _with(_ALLOCATED)
    + """
select order_id, order_detail_id, user_id, p_name spu_name, p_brand tm_name, share_cents
from a join part on sku_id = p_partkey
where dt = '1998-03-02'
  and ('ring' in (select unnest(string_split(p_name, ' ')))
       or 'bolt' in (select unnest(string_split(p_name, ' '))))
order by order_id, order_detail_id limit 10 offset 3"""
)

ORACLES["deep_page"] = """
select l_orderkey order_id, l_partkey sku_id, cast(round(l_extendedprice * 100) as bigint) detail_cents
from lineitem order by detail_cents desc, order_id, sku_id limit 25 offset 5000"""

ORACLES["quarantine_stream"] = """
select case when o_orderkey % 7 = 0 then 'unread' else 'order' end kind,
       case when o_orderkey % 7 = 0 then '{"id":' || o_orderkey else o_orderkey::varchar end record
from orders join customer on o_custkey = c_custkey"""

ORACLES["first_order_flag"] = (
    _with(_ORDER_INFO)
    + """
select id, user_id, create_date, create_hour,
       case when user_id in (select user_id from oi where create_date < '1996-01-01'
                             and order_status = 'F') then '0'
            when row_number() over (partition by user_id order by create_date, create_hour, id) = 1
            then '1' else '0' end if_first_order
from oi where create_date >= '1996-01-01'"""
)

ORACLES["order_enriched"] = (
    _with(_ORDER_INFO, _USERS)
    + """
select oi.id, user_id, n_name province_name, concat('A', n_regionkey) province_area_code,
       concat('ISO-', n_nationkey) province_iso_code, age_group user_age_group,
       gender_name user_gender
from oi left join nation on province_id = n_nationkey left join people on user_id = people.id"""
)

ORACLES["sku_denormalized"] = """
select cast(p_partkey as varchar) id, md5(p_name) spu_id,
       cast(round(p_retailprice * 100) as bigint) price_cents,
       concat_ws(' ', p_type, p_name) sku_name, split_part(p_brand, '#', 2) tm_id,
       md5(p_type) category3_id, p_type category3_name, p_brand tm_name, p_name spu_name
from part"""

ORACLES["order_detail_enriched"] = """
select l_orderkey order_id, cast(l_linenumber as bigint) * 1000000000000 + l_partkey order_detail_id,
       l_partkey sku_id, p_brand tm_name, p_type category3_name, p_name spu_name
from lineitem left join part on l_partkey = p_partkey"""

ORACLES["user_bands"] = (
    _with(_USERS)
    + "select cast(id as varchar) id, birthday, gender, age_group, gender_name from people"
)

# ---- traffic ------------------------------------------------------------------------------------

ORACLES["dau_first"] = _with(_LOGS) + "select mid, dt, hr, ts from firsts"

ORACLES["dau_index"] = ORACLES["dau_first"]

ORACLES["dau_total"] = _with(_LOGS) + "select count(*) dau from firsts where dt = '2024-01-15'"

ORACLES["dau_hourly"] = (
    _with(_LOGS) + "select hr, count(*) dau from firsts where dt = '2024-01-15' group by hr"
)

ORACLES["realtime_hour_dau"] = (
    _with(_LOGS)
    + """
select lpad(cast(h as varchar), 2, '0') hr,
       count(case when dt = '2024-01-15' then 1 end) today,
       count(case when dt = '2024-01-14' then 1 end) yesterday
from range(24) r(h) left join firsts on cast(hr as int) = h and dt in ('2024-01-14', '2024-01-15')
group by h"""
)

ORACLES["realtime_total"] = (
    _with(_ALLOCATED, _LOGS)
    + """
, days as (select unnest(['2024-01-15', '1998-03-02']) dt)
select 'dau' id, '新增日活' as name, (select count(*) from firsts where firsts.dt = days.dt) "value", dt
from days
union all
select 'new_mid', '新增设备',
       (select count(*) from (select mid, min(firsts.dt) f from firsts group by mid) x where f = days.dt), dt
from days
union all
select 'order_amount', '新增交易额',
       cast(coalesce((select sum(share_cents) from a where a.dt = days.dt), 0) as bigint), dt
from days"""
)

ORACLES["route_logs"] = (
    _with(_LOGS)
    + """
select case when ch = 'view' then 'start_log' else 'event_log' end topic,
       mid, ch, ts, ch = 'view' is_start
from logs"""
)

ORACLES["cdc_canal"] = """
select 'ods_order_info' topic, '{"id":' || o_orderkey || ',"order_status":"' || s || '"}' "value"
from (select o_orderkey, unnest([o_orderstatus, 'CLOSED']) s from orders where o_orderkey % 3 <> 2) x
union all
select 'ods_favor_info', '{"id":' || s_suppkey || ',"name":"' || s_name || '"}'
from supplier where s_suppkey % 3 <> 2"""

ORACLES["cdc_maxwell"] = """
select 'ods_order_info' topic, '{"id":' || o_orderkey || ',"user_id":' || o_custkey
       || ',"order_status":"' || o_orderstatus || '"}' "value"
from orders where o_orderkey % 3 = 0
union all
select 'ods_order_detail', '{"order_id":' || l_orderkey || ',"sku_id":' || l_partkey
       || ',"line":' || l_linenumber || '}'
from lineitem where l_orderkey % 3 = 0
union all
select 'ods_base_province', '{"id":' || n_nationkey || ',"name":"' || n_name || '"}' from nation
union all
select 'ods_sku_info', '{"id":' || p_partkey || ',"sku_name":"' || p_name || '"}' from part"""

# ---- ratings ------------------------------------------------------------------------------------

ORACLES["rating_counts"] = (
    _with(_RATING) + 'select mid, count(mid) "count" from rating group by mid'
)

ORACLES["rating_counts_by_month"] = (
    _with(_RATING)
    + """
select mid, count(mid) "count", cast(strftime(make_timestamp("timestamp" * 1000000), '%Y%m') as int) "yearOfMonth"
from rating group by all"""
)

ORACLES["average_scores"] = (
    _with(_RATING) + "select mid, round(avg(score), 6) avg from rating group by mid"
)

ORACLES["tags_per_item"] = (
    _with(_TAG)
    + "select mid, array_to_string(list_sort(list(distinct tag)), '|') tags from tag group by mid"
)

ORACLES["movies_with_tags"] = (
    _with(_TAG, _MOVIE)
    + """
, t as (select mid, array_to_string(list_sort(list(distinct tag)), '|') tags from tag group by mid)
select movie.mid, name, genres, tags from movie left join t on t.mid = movie.mid"""
)

ORACLES["genre_top_n"] = (
    _with(_RATING, _MOVIE)
    + """
, g as (select unnest(['Economy', 'Small', 'Standard', 'Medium', 'Large', 'Promo']) genre),
s as (select mid, avg(score) avg from rating group by mid),
r as (
  select genre, row_number() over (partition by genre order by avg desc, movie.mid) rank, movie.mid, avg
  from g join movie on contains(lower(genres), lower(genre)) join s on s.mid = movie.mid)
select genre, rank, mid, round(avg, 6) avg from r where rank <= 10"""
)

ORACLES["recent_ratings"] = _with(_RATING, _RECENT) + "select * from recent"

ORACLES["top_unseen_similar"] = (
    _with(_RATING, _MOVIE, _SET_SIM, _RECENT, _UNSEEN)
    + "select uid, mid, rank, candidate, round(score, 6) score from unseen"
)

ORACLES["rescore"] = (
    _with(_RATING, _MOVIE, _SET_SIM, _RECENT, _UNSEEN)
    + """
select c.uid, c.candidate mid,
       round(avg(s.score * r.score)
             + log10(greatest(count(case when r.score > 3 then 1 end), 1))
             - log10(greatest(count(case when r.score <= 3 then 1 end), 1)), 6) score
from unseen c join recent r on r.uid = c.uid
     join sim s on s.mid = c.candidate and s.other_mid = r.mid and s.score > 0.7
group by c.uid, c.candidate"""
)

# ---- similarity ---------------------------------------------------------------------------------

ORACLES["content_similar_exact"] = (
    _with(_MOVIE, _TFIDF) + "select profile, other_profile, round(score, 6) score from psim"
)

ORACLES["content_similar_top"] = (
    _with(_MOVIE, _TFIDF)
    + """
select * from (
  select a.mid, row_number() over (partition by a.mid order by score desc, b.mid) rank,
         b.mid other_mid, round(score, 6) score
  from psim join prof a on a.profile = psim.profile join prof b on b.profile = psim.other_profile
  where a.mid <> b.mid) x
where rank <= 20"""
)

ORACLES["similar_vectors"] = """
select * from (
  select a.vec_id, b.vec_id other_id,
         round(round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9), 6) score
  from embeddings a join embeddings b on a.vec_id <> b.vec_id) x
where score > 0.3"""

# ---- documents, text and tables -------------------------------------------------------------------

ORACLES["word_count"] = r"""
select word, count(*) n
from (select unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) word from documents) x
where word <> '' group by word"""

_DOC_HIT = r"""list_has_any(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), %s)"""

ORACLES["doc_search"] = (
    r"""
select id, "doubanScore", array_to_string(list_transform(
         regexp_extract_all(name, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'),
         lambda t: case when lower(t) in ('the', 'and') then '<em>' || t || '</em>' else t end), '') highlighted
from (select doc_id id, cast(n_chars as double) "doubanScore", text as name
      from documents where """
    + _DOC_HIT % "['the', 'and']"
    + ' order by "doubanScore" desc, id limit 10 offset 10) x'
)

ORACLES["doc_search_actor"] = (
    r"""
select doc_id id, cast(n_chars as double) "doubanScore" from documents
where """
    + _DOC_HIT % "['the']"
    + r""" and list_contains(list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> ''), 'The')
order by 2, 1 limit 20"""
)

ORACLES["get_by_id"] = """
select doc_id id, text as name, cast(n_chars as double) "doubanScore" from documents where doc_id = 7"""

ORACLES["nested_text"] = """
select cast(p_partkey as varchar) as name, replace(p_name, ' ', '|') friends, p_size size,
       cast(p_partkey as int) "key", p_type street, p_brand city
from part"""

ORACLES["table_layout"] = """
select l_returnflag, o_orderstatus, count(*) n_lines
from lineitem join orders on l_orderkey = o_orderkey group by all"""

ORACLES["compact_files"] = (
    "select o_orderstatus, count(*) n_orders from orders group by o_orderstatus"
)

ORACLES["load_movies"] = (
    _with(_MOVIE) + "select mid, name, genres, true no_directors from movie"
)

ORACLES["load_ratings"] = (
    _with(_RATING) + 'select uid, mid, score, cast("timestamp" as int) "timestamp" from rating'
)

ORACLES["load_tags"] = _with(_TAG) + "select * from tag"

ORACLES["load_rating_events"] = ORACLES["load_ratings"]

ORACLES["order_json_round_trip"] = (
    _with(_ORDER_INFO)
    + """
select id, user_id, final_cents / 100 final_total_amount, create_date, create_hour, true well_formed
from oi"""
)

ORACLES["land_raw_logs"] = _with(_LOGS) + "select dt, count(*) n from logs group by dt"

ORACLES["user_status_upsert"] = (
    _with(_ORDER_INFO)
    + """
select user_id, max(concat(create_date, ' ', create_hour, ':00:00')) create_time,
       arg_max(id, concat(create_date, ' ', create_hour, lpad(cast(id as varchar), 20, '0'))) id,
       arg_max(order_status, concat(create_date, ' ', create_hour, lpad(cast(id as varchar), 20, '0'))) order_status
from oi group by user_id"""
)

ORACLES["genre_list"] = """
select genre, count(t) n
from (select unnest(['Economy', 'Small', 'Standard', 'Medium', 'Large', 'Promo']) genre) g
     left join (select unnest(list_distinct(string_split(lower(p_type || '|' || replace(p_name, ' ', '|')), '|'))) t
                from part) w on lower(genre) = t
group by genre"""

# ---- streams --------------------------------------------------------------------------------------

# Allocation with lines in the order of a digest id instead of their line number.
_LINE_HASH = """
cast('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
  cast(l_quantity as bigint), cast(round(l_extendedprice * 100) as bigint),
  cast(round(l_discount * 100) as bigint), cast(round(l_tax * 100) as bigint),
  strftime(l_shipdate, '%Y-%m-%d'), l_returnflag, l_linestatus)), 1, 15) as bigint)"""
_ALLOCATED_BY_HASH = _ALLOCATED.replace(
    "cast(l_linenumber as bigint) * 1000000000000 + l_partkey order_detail_id", _LINE_HASH + " order_detail_id"
).replace(
    """order by l_linenumber, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag,
           l_linestatus)""",
    "order by " + _LINE_HASH + ")",
)

ORACLES["dau_stream"] = _with(_LOGS) + "select distinct mid, dt from logs"

ORACLES["route_cdc_stream"] = (
    'select topic, count(*) n from (' + ORACLES["cdc_maxwell"] + ") x group by topic"
)

ORACLES["sku_dimension_stream"] = (
    "select id, spu_id, sku_name, tm_id, category3_id, category3_name, tm_name, spu_name from ("
    + ORACLES["sku_denormalized"]
    + ") x"
)

ORACLES["user_dimension_stream"] = ORACLES["user_bands"]

ORACLES["order_join_stream"] = (
    _with(_ALLOCATED_BY_HASH)
    + "select order_id, order_detail_id, user_id, sku_id, detail_cents, final_cents, dt from a"
)

ORACLES["alloc_stream"] = (
    _with(_ALLOCATED_BY_HASH) + "select order_id, order_detail_id, share_cents from a"
)

ORACLES["first_order_stream"] = (
    _with(_ORDER_INFO)
    + """
select id, user_id,
       case when row_number() over (partition by user_id order by create_date, create_hour, id) = 1
            then '1' else '0' end if_first_order
from oi"""
)

ORACLES["dimension_changes_stream"] = """
select cast(p_partkey as varchar) tm_id, case when p_partkey % 2 = 0 then 'omega' else 'alpha' end tm_name
from part where p_partkey % 3 <> 0"""

ORACLES["online_recs_stream"] = ORACLES["rescore"]

ORACLES["ads_once"] = (
    _with(_ALLOCATED_BY_HASH)
    + """
select split_part(p_brand, '#', 2) tm_id, p_brand tm_name, cast(sum(share_cents) as bigint) amount_cents
from a join part on sku_id = p_partkey group by p_brand"""
)
