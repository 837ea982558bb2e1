"""The expected result of every query, in DuckDB's SQL over the raw tables.

The feeds are rebuilt here from ``events`` on their own, and the merges are
spelled out in full: every pair is joined before the latest row is picked.
"""

from __future__ import annotations

from checks.feeds import EXEC_DATE, GROUP, LOWER, SNAPSHOT_DATE, TOPIC

# Spelled out here, so that an error in the library's lists cannot hide.
POST_COLUMNS = """
    authorurl accounttype accountfollowers bloganslanguage blogfollowers blogid blogtype
    commentscount id isspam likescount metrictimestamp parentid partdate posttype posturl
    repostscount socialnetworktype topics viewscount currenttimestamp kafkapartition
    kafkaoffset execdate
""".split()
METRIC_COLUMNS = """
    blogtype blogurl partdate comments likes reposts views commentnegativecount
    commentpositivecount metricstimestamp metricstype metricsurl currenttimestamp
    kafkapartition kafkaoffset id execdate
""".split()
MERGED_COLUMNS = """
    authorurl accounttype accountfollowers bloganslanguage blogfollowers blogid blogtype
    commentscount isspam likescount metrictimestamp parentid posttype posturl repostscount
    socialnetworktype topics viewscount currenttimestamp kafkapartition kafkaoffset execdate
    blogtype_metrics blogurl commentnegativecount commentpositivecount metricstimestamp
    metricstype metricsurl currenttimestamp_metrics kafkapartition_metrics
    kafkaoffset_metrics execdate_metrics partdate_pmd post_id
""".split()
OVERRIDES = {"commentscount": "comments", "likescount": "likes", "repostscount": "reposts", "viewscount": "views"}
SUFFIX = "_metrics"

ALL = "'view', 'click', 'signup', 'purchase', 'error'"
NOW = "2024-01-20 06:00:00"
DAY = "strftime(ts, '%Y-%m-%d')"
STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
METRIC_TIME = f"""case when event_id % 7 = 0
      then strftime(ts + interval 3 hour, '%Y-%m-%dT%H:%M:%S.%f') || '+03:00' else {STAMP} end"""
METRIC_DAY = """cast(case when partdate like '%+03:00'
      then cast(left(partdate, 26) as timestamp) - interval 3 hour
      else cast(partdate as timestamp) end as date)"""
POST_TIME = f"""case when event_id % 7 = 0
      then strftime(ts - interval 5 hour, '%Y-%m-%dT%H:%M:%S.%f') || '-05:00' else {STAMP} end"""
ALL_POSTS, ALL_METRICS = "'view', 'error', 'signup'", "'click', 'purchase'"
POST_URL = """'https://p.example/' || user_id || '/' || strftime(
      case when user_id % 2 = 0 then date_trunc('week', ts) else ts end, '%Y-%m-%d')"""


def posts(types: str = "'view', 'error'") -> str:
    return f"""
    select 'https://a.example/' || user_id authorurl, user_id % 4 accounttype,
      user_id * 10 accountfollowers, user_id % 3 bloganslanguage, event_id % 500 blogfollowers,
      md5('blog/' || user_id) blogid, user_id % 5 blogtype,
      cast(floor(value) as bigint) commentscount, md5({POST_URL}) id, event_id % 50 = 0 isspam,
      event_id % 97 likescount, {STAMP} metrictimestamp,
      case when event_id % 4 = 0 then md5('parent/' || (user_id % 20)) end parentid,
      ts partdate, event_id % 6 posttype, {POST_URL} posturl, event_id % 13 repostscount,
      user_id % 7 socialnetworktype, (event_id % 9) || ',' || (case when event_id % 11 = 0 then 'null' else cast(user_id % 9 as varchar) end) topics,
      case when event_id % 3 = 0 then null else event_id % 1000 end viewscount,
      ts + interval 1 hour currenttimestamp, cast(user_id % 16 as int) kafkapartition,
      event_id kafkaoffset, '{EXEC_DATE}' execdate
    from events where event_type in ({types})"""


def metrics(types: str = "'click'") -> str:
    return f"""
    select user_id % 5 blogtype, 'https://b.example/' || user_id blogurl, {METRIC_TIME} partdate,
      case when event_id % 5 = 0 then null else event_id % 200 end comments,
      event_id % 300 likes, event_id % 40 reposts, event_id % 5000 "views",
      event_id % 11 commentnegativecount, event_id % 12 commentpositivecount,
      {STAMP} metricstimestamp, event_id % 2 metricstype, {POST_URL} metricsurl,
      ts + interval 2 hour currenttimestamp, cast(user_id % 16 as int) kafkapartition,
      event_id kafkaoffset, md5({POST_URL}) id, '{EXEC_DATE}' execdate
    from events where event_type in ({types})"""


def blogs(types: str = "'view', 'click'") -> str:
    account = "user_id || '/' || (event_id % 10)"
    return f"""
    select md5('blog/' || {account}) accountid, 'https://b.example/' || {account} accounturl,
      case when user_id % 3 = 0 then null else 'https://i.example/' || user_id end avatarurl,
      {STAMP} partdate, 'nick' || (event_id % 7) nickname, 'nick' || (event_id % 7) "name",
      '1990-01-' || (10 + user_id % 10) birthdate, user_id % 4 educationlevel,
      user_id % 7 socialnetworktype, user_id % 5 blogtype,
      cast(user_id % 16 as int) kafkapartition, event_id kafkaoffset,
      value commentsaverage, value / 2 repostsaverage, value * 2 viewsaverage,
      value / 4 likesaverage, value / 8 postsaverage, event_id % 100 commentscount,
      event_id % 10 repostscount, event_id % 1000 viewscount, event_id % 300 likescount,
      event_id % 20 postscount, {DAY} execdate, ts currenttimestamp
    from events where event_type in ({types})"""


OLD_BLOGS = "'signup', 'purchase', 'error'"


def newest(source: str, keys: str, order: str) -> str:
    """Latest row per key of a named relation."""
    return f"""
    select * exclude (rn) from (
      select *, row_number() over (partition by {keys} order by {order}) rn from {source})
    where rn = 1"""


BLOG_ORDER = "currenttimestamp desc nulls last, kafkaoffset desc, kafkapartition desc"


def text_time(*columns: str) -> str:
    """A ``replace`` list that shows timestamps as text."""
    shown = [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') as {c}" for c in columns]
    return f"replace ({', '.join(shown)})"


def pairs_select() -> str:
    """Every column of a joined post ``p`` and metric ``m``."""
    out = []
    for c in POST_COLUMNS:
        if c in OVERRIDES:
            out.append(f"coalesce(m.{OVERRIDES[c]}, p.{c}) {c}")
        elif c not in ("id", "partdate"):
            out.append(f"p.{c}")
    for c in METRIC_COLUMNS:
        if c not in ("id", "partdate") and c not in OVERRIDES.values():
            out.append(f"m.{c} {c + SUFFIX if c in POST_COLUMNS else c}")
    out += ["coalesce(p.day, m.day) partdate_pmd", "coalesce(p.id, m.id) post_id"]
    return ", ".join(out)


PAIR_ORDER = """metricstimestamp desc nulls last, metrictimestamp desc nulls last,
    kafkaoffset_metrics desc nulls last, kafkapartition_metrics desc nulls last,
    kafkaoffset desc nulls last, kafkapartition desc nulls last, partdate_pmd desc"""


def pairs(name: str, post_sql: str, metric_sql: str, gate: bool, lower: str, upper: str) -> str:
    """CTEs ``<name>_p``, ``<name>_m`` and the joined ``<name>_pairs``."""
    span = f"between date '{lower}' and date '{upper}'"
    keep = f"and {METRIC_DAY} in (select day from {name}_p)" if gate else ""
    return f"""
    {name}_p as (select *, cast(partdate as date) as day from ({post_sql})
      where cast(partdate as date) {span}),
    {name}_m as (select *, {METRIC_DAY} as day from ({metric_sql})
      where {METRIC_DAY} {span} {keep}),
    {name}_pairs as (select {pairs_select()} from {name}_p p full outer join {name}_m m
      on p.id = m.id and p.day = m.day)"""


def latest_pairs(name: str) -> str:
    return f"{name} as ({newest(name + '_pairs', 'post_id', PAIR_ORDER)})"


def delta(name: str = "delta") -> str:
    return pairs(name, posts(), metrics(), True, LOWER, EXEC_DATE) + ", " + latest_pairs(name)


def history(name: str = "hist") -> str:
    made = pairs(name, posts("'signup'"), metrics("'purchase'"), True, "2024-01-01", "2024-01-30")
    return made + ", " + latest_pairs(name)


def overlaid(name: str, new: str, old: str, where: str = "true") -> str:
    """CTE ``name``: ``new`` laid over those rows of ``old`` that match ``where``."""
    columns = ", ".join(f"coalesce(d.{c}, h.{c}) {c}" for c in MERGED_COLUMNS)
    return f"""
    {name} as (select {columns} from (select * from {old} where {where}) h
      full outer join {new} d on d.post_id = h.post_id and d.partdate_pmd = h.partdate_pmd)"""


READING = "partdate_pmd, post_id, metrictimestamp"
READING_ORDER = """metricstimestamp desc nulls last, currenttimestamp desc nulls last,
    kafkaoffset_metrics desc nulls last, kafkapartition_metrics desc nulls last,
    kafkaoffset desc nulls last, kafkapartition desc nulls last"""
PROCESSED = "partdate_pmd in (select day from delta_p)"
MERGED_TEXT = (
    "replace (strftime(currenttimestamp, '%Y-%m-%d %H:%M:%S.%f') as currenttimestamp, "
    "strftime(currenttimestamp_metrics, '%Y-%m-%d %H:%M:%S.%f') as currenttimestamp_metrics, "
    "cast(partdate_pmd as varchar) as partdate_pmd)"
)


def merged_columns(source: str) -> str:
    return f"select {', '.join(MERGED_COLUMNS)} from {source}"


def show_merged(source: str) -> str:
    return f"select * {MERGED_TEXT} from ({merged_columns(source)})"


OVERLAID = f"with {delta()}, {history()}, {overlaid('overlaid', 'delta', 'hist', PROCESSED)}"
MERGED = f"{OVERLAID}, merged as ({newest('overlaid', READING, READING_ORDER)})"


def batched(size: int) -> str:
    """The merge with one latest row per post and batch of days."""
    return f"""with {delta()}, {history()},
    batches as (select day, (dense_rank() over (order by day) - 1) // {size} batch
      from (select distinct day from delta_p)),
    numbered as (select x.*, b.batch from delta_pairs x join batches b on b.day = x.partdate_pmd),
    parts as ({newest('numbered', 'post_id, batch', PAIR_ORDER)}),
    {overlaid('overlaid', 'parts', 'hist', PROCESSED)},
    merged as ({newest('overlaid', READING, READING_ORDER)})
    {show_merged('merged')}"""


REPLACED = f"""{MERGED} {show_merged(f'''(
      {merged_columns('merged')} union all
      {merged_columns(f'(select * from hist where not {PROCESSED})')})''')}"""

FULL_LOG = f"""select cast(user_id % 16 as int) kafkapartition, max(event_id) latestoffset,
      case when event_type in ('view', 'error') then 'Posts' when event_type = 'signup' then 'Blogs'
        else 'Metrics' end topic, 'g' || (1 + event_id % 2) consumergroup, {DAY} execdate,
      strftime(ts, '%H') || '-00' exectime
    from events group by all"""
LOG = f"select * from ({FULL_LOG}) where topic = '{TOPIC}' and consumergroup = '{GROUP}'"
READ_LOG = f"""select cast(user_id % 16 as int) kafkapartition, max(event_id) latestoffset
    from events where ts < timestamp '2024-01-15' group by all"""
PARTITIONS = "select cast(i as int) kafkapartition from range(18) t(i)"


def resumed(scope: str, missing: int) -> str:
    only = "where (execdate, exectime) = (select max((execdate, exectime)) from log)"
    return f"""log as ({LOG}), parts as ({PARTITIONS}),
    seen as (select kafkapartition, max(latestoffset) + 1 startingoffset from log
      {only if scope == 'latest_run' else ''} group by 1),
    starts as (select kafkapartition, coalesce(startingoffset, {missing}) startingoffset
      from parts left join seen using (kafkapartition))"""


FIRST_RUN = f"""with {pairs('delta', posts(ALL_POSTS), metrics(ALL_METRICS), True, LOWER, EXEC_DATE)},
    {latest_pairs('delta')} {show_merged('delta')}"""

MESSAGE = """cast(user_id % 16 as int) as "partition", event_id as "offset" """
FIRST_RUN_ENDS = "2024-01-15"

SNAPSHOT = f"""snap as (select *, '{SNAPSHOT_DATE.replace('-', '')}' mergedate
      from ({newest('(' + blogs(OLD_BLOGS) + ')', 'accountid', BLOG_ORDER)})),
    fresh as (select *, '{EXEC_DATE.replace('-', '')}' mergedate
      from ({newest('(' + blogs() + ')', 'accountid', BLOG_ORDER)}))"""
BLOG_TEXT = text_time("currenttimestamp")


def every_account(day: str, where: str = "true") -> str:
    rows = f"(select * from ({blogs(ALL)}) where {where})"
    return f"""select *, '{day.replace('-', '')}' mergedate from (
      select * {BLOG_TEXT} from ({newest(rows, 'accountid', BLOG_ORDER)}))"""


MERGED_BLOGS = f"""with {SNAPSHOT}, both_sides as (select * from snap union all by name
      select * from fresh)
    select * {BLOG_TEXT} from ({newest('both_sides', 'accountid', BLOG_ORDER)})"""


def decoded(feed_sql: str, *times: str) -> str:
    """A feed as its messages decode to: stamped with the time of the run."""
    return f"""select * {text_time(*times)} from (
      select * replace (timestamp '{NOW}' as currenttimestamp, '{EXEC_DATE}' as execdate)
      from ({feed_sql}))"""


LINE_ORDER = """l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc,
    l_extendedprice desc, l_quantity desc, l_discount desc, l_tax desc"""

DECODED_POSTS = f"""select posturl, partdate, posttype, language, spam, topics,
      author, followers from (
    select {POST_URL} posturl, {POST_TIME} partdate, event_id % 6 posttype,
      user_id % 3 as language, event_id % 50 = 0 spam, 2 topics,
      'https://a.example/' || user_id author, event_id % 500 followers from events)"""

def ingested(feed_sql: str, key: str) -> str:
    """Two runs: rows with their key unless broken, broken text, offsets and counts."""
    return f"""with feed as (select kafkapartition, kafkaoffset, kafkaoffset % 20 = 0 broken, "{key}" k,
        case when moment < timestamp '{FIRST_RUN_ENDS}' then 0 else 1 end run
      from ({feed_sql}) join (select event_id, ts moment from events) on event_id = kafkaoffset)
    select 'row' kind, kafkapartition, kafkaoffset, case when not broken then k end "text" from feed
    union all select 'broken', kafkapartition, kafkaoffset, '{{broken ' || kafkaoffset from feed where broken
    union all select 'offset', kafkapartition, max(kafkaoffset), null from feed group by kafkapartition, run
    union all select 'count', run, count(*), 'rows' from feed group by run
    union all select 'count', run, count(*) filter (where broken), 'keyless' from feed group by run
    union all select 'count', run, count(*) filter (where broken), 'broken' from feed group by run"""


def day_step(k: int, upper: str, before: str, after: str) -> str:
    """One day's half of the feeds laid over ``before``, whole dates replaced: CTE ``after``."""
    half = lambda sql: f"select * from ({sql}) where kafkaoffset % 2 = {k}"
    name = f"d{k}"
    touched = f"partdate_pmd in (select day from {name}_p)"
    return f"""{pairs(name, half(posts()), half(metrics()), True, LOWER, upper)}, {latest_pairs(name)},
    {overlaid(f'o{k}', name, before, touched)},
    n{k} as ({newest(f'o{k}', READING, READING_ORDER)}),
    {after} as (select * from ({merged_columns(f'n{k}')}) union all
      select * from ({merged_columns(before)}) where not {touched})"""


SHOWN = "likescount, viewscount, commentscount, kafkaoffset"
MERGED_DAYS = f"""with {SNAPSHOT}, {history()}, {day_step(0, '2024-01-19', 'hist', 'h0')},
    {day_step(1, EXEC_DATE, 'h0', 'h1')},
    fed as (select *, case when kafkaoffset % 2 = 0 then '20240119' else '{EXEC_DATE.replace('-', '')}' end mergedate
      from ({blogs()})),
    every as (select * from snap union all by name select * from fed)
    select 'post' kind, post_id "key", cast(partdate_pmd as varchar) "day", {SHOWN} from h1
    union all
    select 'account', accountid, mergedate, {SHOWN} from ({newest('every', 'accountid', BLOG_ORDER)})"""

SQL: dict[str, str] = {
    # scans
    "scan_earliest": f"select {MESSAGE} from events",
    "scan_from_offsets": f"""with {resumed('all_runs', -2).replace(LOG, READ_LOG)}
    select {MESSAGE} from events join starts on user_id % 16 = kafkapartition
    where event_id >= startingoffset""",
    "scan_resume_or_earliest": f"""with cut as (select user_id % 16 p, max(event_id) last
      from events where ts < timestamp '{FIRST_RUN_ENDS}' group by 1)
    select 'first' run, {MESSAGE} from events where ts < timestamp '{FIRST_RUN_ENDS}'
    union all
    select 'second' run, {MESSAGE} from events left join cut on user_id % 16 = p
    where event_id > coalesce(last, -1)""",
    "scan_day_deltas": f"""select * {BLOG_TEXT} from ({blogs(ALL)})
    where execdate = '{EXEC_DATE}'""",
    "scan_declared_schema": f"select * {text_time('partdate', 'currenttimestamp')} from ({posts(ALL)})",
    "scan_history_partitions": f"""with {delta()}, {history()}
    {show_merged(f'(select * from hist where {PROCESSED})')}""",
    "scan_csv": f"select * {text_time('currenttimestamp')} from ({metrics(ALL)}) where comments is not null",
    "scan_evolved_schema": """with e as (select *, case when ts < timestamp '2024-01-18' then 1
        when ts < timestamp '2024-01-19' then 2 else 3 end run from events)
    select event_id id, case run when 1 then floor(value) when 2 then floor(value) + 0.5 end amount,
      case when run = 3 then 'c' || (user_id % 7) else cast(user_id % 7 as varchar) end code,
      case when run = 3 then 'u' || user_id else cast(user_id as varchar) end user_id,
      case when run = 2 then event_type end kind,
      case run when 1 then (user_id % 3) || ',' || (event_id % 5) when 2 then cast(user_id % 3 as varchar) else event_type end tags,
      case when run = 3 then user_id % 2 = 0 end even, event_id kafkaoffset from e""",
    # decoding
    "decode_json": DECODED_POSTS,
    "json_infer_schema": DECODED_POSTS,
    "decode_json_missing_fields": f"""select md5({POST_URL}) id, {POST_URL} posturl,
      {STAMP.replace('T%H', ' %H')} partdate, cast(null as varchar) authorurl,
      cast(null as bigint) blogfollowers, cast(null as bigint) commentscount,
      cast(null as varchar) topics from events""",
    "flatten_posts": decoded(posts(ALL), "partdate", "currenttimestamp"),
    "flatten_blogs": decoded(blogs(ALL), "currenttimestamp"),
    "flatten_metrics": decoded(metrics(ALL), "currenttimestamp"),
    "topics_ids": """select event_id as "offset",
      (event_id % 9) || ',' || (case when event_id % 11 = 0 then 'null' else cast(user_id % 9 as varchar) end) topics from events""",
    # projections and filters
    "suffix_collisions": f"""select blogtype blogtype_metrics, blogurl, partdate partdate_metrics,
      comments, likes, reposts, "views", commentnegativecount, commentpositivecount,
      metricstimestamp, metricstype, metricsurl,
      strftime(currenttimestamp, '%Y-%m-%d %H:%M:%S.%f') currenttimestamp_metrics,
      kafkapartition kafkapartition_metrics, kafkaoffset kafkaoffset_metrics, id id_metrics,
      execdate execdate_metrics from ({metrics(ALL)})""",
    "filter_date_range": f"""select kafkaoffset, cast(cast(partdate as date) as varchar) "day"
    from ({posts(ALL)}) where cast(partdate as date) between '{LOWER}' and '{EXEC_DATE}'
    union all
    select kafkaoffset, cast({METRIC_DAY} as varchar) "day"
    from ({metrics(ALL)}) where {METRIC_DAY} between '{LOWER}' and '{EXEC_DATE}'""",
    "filter_batch_dates": f"""with p as (select cast(partdate as date) as day from ({posts(ALL_POSTS)})
      where cast(partdate as date) between '{LOWER}' and '{EXEC_DATE}')
    select 'frame' how, kafkaoffset from ({metrics(ALL_METRICS)})
    where {METRIC_DAY} in (select day from p)
    union all
    select 'list' how, kafkaoffset from ({metrics(ALL_METRICS)})
    where {METRIC_DAY} in (date '{LOWER}', date '{EXEC_DATE}')""",
    "distinct_partitions": f"""select distinct cast(cast(partdate as date) as varchar) "day"
    from ({posts(ALL_POSTS)}) where cast(partdate as date) between '{LOWER}' and '{EXEC_DATE}'""",
    # joins and merges
    "merge_delta_posts_metrics": f"""with {pairs('delta', posts(ALL_POSTS), metrics(ALL_METRICS), False, LOWER, EXEC_DATE)}
    {show_merged('delta_pairs')}""",
    "latest_post_with_metrics": f"""with {pairs('delta', posts(ALL_POSTS), metrics(ALL_METRICS), False, LOWER, EXEC_DATE)},
    {latest_pairs('delta')} {show_merged('delta')}""",
    "latest_posts_metrics_fused": FIRST_RUN,
    "overlay_history": f"""with {delta()}, {history()}, {overlaid('o', 'delta', 'hist')}
    {show_merged('o')}""",
    "merge_posts_history": f"""with {delta()}, {history()}, {overlaid('o', 'delta', 'hist')},
    merged as ({newest('o', READING, READING_ORDER)}) {show_merged('merged')}""",
    "merge_posts_metrics": f"{MERGED} {show_merged('merged')}",
    "merge_posts_batched": batched(7),
    "merge_posts_first_run": FIRST_RUN,
    "dedupe_blogs_delta": f"select * {BLOG_TEXT} from ({newest('(' + blogs(ALL) + ')', 'accountid', BLOG_ORDER)})",
    "union_history_delta": f"""with {SNAPSHOT} select * {BLOG_TEXT} from (
      select * from snap union all by name select * from ({blogs()}))""",
    "merge_blogs": MERGED_BLOGS,
    "merge_blogs_bucketed": MERGED_BLOGS,
    "merge_blogs_first_run": every_account(EXEC_DATE),
    "latest_per_key": newest("lineitem", "l_orderkey", LINE_ORDER).replace(
        "* exclude (rn)",
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
        "l_discount, l_tax, l_returnflag, l_linestatus, "
        "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') l_shipdate",
    ),
    # offsets
    "offsets_commit": f"""select kafkapartition, max(kafkaoffset) latestoffset, topic,
      '{GROUP}' consumergroup, '{EXEC_DATE}' execdate, exectime from (
      select cast(user_id % 16 as int) kafkapartition, event_id kafkaoffset, '{TOPIC}' topic,
        case when ts < timestamp '{FIRST_RUN_ENDS}' then '06-00' else '07-00' end exectime
      from events) group by all""",
    "offsets_latest_run": f"""with log as ({LOG})
    select kafkapartition, latestoffset + 1 startingoffset, execdate, exectime from log
    where (execdate, exectime) = (select max((execdate, exectime)) from log)""",
    "offsets_resume": f"with {resumed('all_runs', -2)} select * from starts",
    "offsets_resume_latest_run": f"with {resumed('latest_run', -1)} select * from starts",
    "offsets_compact": f"""select kafkapartition, latestoffset, topic, consumergroup, execdate, exectime
    from ({newest('(' + FULL_LOG + ')', 'topic, consumergroup, kafkapartition',
      'latestoffset desc, execdate desc, exectime desc')})""",
    "offsets_json": f"""with {resumed('all_runs', -2)}
    select '{{"{TOPIC}":{{' || string_agg('"' || kafkapartition || '":' || startingoffset, ','
      order by kafkapartition) || '}}}}' startingoffsets from starts""",
    # sinks
    "sink_run_dir": decoded(blogs(ALL), "currenttimestamp"),
    "sink_partitioned": f"""select * exclude (day_), strftime(day_, '%Y-%m-%d') postdate
      from (select * {text_time('partdate', 'currenttimestamp')},
        cast(partdate as date) day_ from ({posts(ALL)}))""",
    "sink_clustered": f"""select * exclude (day_), strftime(day_, '%Y-%m-%d') postdate
      from (select * {text_time('partdate', 'currenttimestamp')},
        cast(partdate as date) day_ from ({posts(ALL)}))""",
    "sink_snapshot": every_account(SNAPSHOT_DATE),
    "merge_posts_bucketed": REPLACED,
    "merge_posts_by_parts": REPLACED,
    "replace_partitions": REPLACED,
    # pipelines
    "ingest_posts": ingested(posts(ALL), "id"),
    "ingest_metrics": ingested(metrics(ALL), "id"),
    "ingest_blogs": ingested(blogs(ALL), "accountid"),
    "merge_blogs_after_gap": f"""select * replace (
      case when execdate = '2024-01-17' then '20240117' else mergedate end as mergedate)
      from ({every_account("2024-01-19", "execdate in ('2024-01-17', '2024-01-18', '2024-01-19')")})""",
    "merge_blogs_layers": f"""select * replace (replace(execdate, '-', '') as mergedate)
      from ({every_account(EXEC_DATE, f"execdate between '2024-01-17' and '{EXEC_DATE}'")})""",
    "merge_late_runs": f"""select * replace (case
      when kafkaoffset % 3 <> 0 and execdate = '2024-01-17' then '20240117'
      when execdate = '2024-01-19' and kafkaoffset % 3 = 0 or execdate = '2024-01-20' then '20240120'
      when kafkaoffset % 3 = 0 and execdate = '2024-01-18' then '20240119'
      else '20240119' end as mergedate)
      from ({every_account("2024-01-19", "execdate in ('2024-01-17', '2024-01-18', '2024-01-19')")})""",
    "offset_gaps": """with rows_ as (select user_id % 16 as p, event_id as o from events),
    read_ as (select * from rows_ where o % 7 <> 3 union all select * from rows_ where o % 11 = 5),
    times as (select p, o, count(*) n from read_ group by p, o),
    bounds as (select p, min(o) lo from times group by p),
    ends as (select p, max(o) + 3 hi from rows_ group by p),
    unseen as (select p, o from (select ends.p, unnest(range(coalesce(lo, 0), hi + 1)) o from ends left join bounds on ends.p = bounds.p)
      where (p, o) not in (select (p, o) from times)),
    marked as (select 'lost' kind, p, o from unseen union all select 'repeated', p, o from times where n > 1),
    ranked as (select kind, p, o, o - row_number() over (partition by kind, p order by o) i from marked)
    select kind, cast(p as int) kafkapartition, min(o) "first", max(o) "last", max(o) - min(o) + 1 offsets from ranked group by kind, p, i""",
    "merge_day": MERGED_DAYS,
    "retention_keep": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') o_orderdate, o_orderpriority
    from orders where not (cast(o_orderdate as date)
      between date '1997-01-01' and date '1998-12-31')""",
    "retention_expired": """select strftime(d, '%Y-%m-%d') "day", count(o_orderkey) rows_expired
    from (select unnest(generate_series(timestamp '1997-01-01', timestamp '1998-12-31',
      interval 1 day)) d) left join orders on cast(o_orderdate as date) = cast(d as date)
    group by 1""",
    "retention_remove": f"""with s as ({blogs(ALL)})
    select accountid, kafkaoffset, execdate from s
    where execdate not between '{LOWER}' and '{EXEC_DATE}'""",
    "retention_guarded": f"""with hours as (select cast(ts as date) runday, hour(ts) h from events group by 1, 2)
    select strftime(runday, '%Y-%m-%d') runday, count(*) runs, count(*) filter (day(runday) % 3 = 0 and h % 5 = 0) pending,
      case when pending > 0 then pending || ' of ' || runs || ' runs are not merged' end reason
    from hours where runday between date '{LOWER}' and date '{EXEC_DATE}' group by 1""",
    # scalar functions
    "url_key": "select page_id, md5(url) url_key from pages",
    "url_key_sha1": "select page_id, substr(sha1(url), 1, 32) url_key from pages",
    "url_key_sha256": "select page_id, substr(sha256(url), 1, 32) url_key from pages",
    "key_bucket": """select c_custkey,
      cast(cast('0x' || substr(md5('c/' || c_custkey), 1, 15) as bigint) % 255 as int) bucket
    from (select o_custkey c_custkey from orders union all select c_custkey from customer)""",
    "exec_date_formats": """select o_orderkey, strftime(o_orderdate, '%Y%m%d') compact,
      strftime(o_orderdate, '%Y-%m-%d') dashed from orders""",
    "run_window": """select o_orderkey,
      strftime(o_orderdate - interval 1 day, '%Y-%m-%d') exec_date,
      strftime(o_orderdate - interval 30 day, '%Y-%m-%d') lower_bound,
      strftime(o_orderdate - interval 10 day, '%Y-%m-%d') expire_from,
      strftime(o_orderdate - interval 1 day, '%Y-%m-%d') expire_to from orders""",
    # streaming
    "stream_ingest_posts": decoded(posts(ALL), "partdate", "currenttimestamp"),
    "stream_ingest_metrics": decoded(metrics(ALL), "currenttimestamp"),
    "stream_ingest_blogs": decoded(blogs(ALL), "currenttimestamp"),
    "stream_upsert_blogs": f"""select *, '{EXEC_DATE.replace('-', '')}' mergedate from (
      select * {BLOG_TEXT} from ({newest('(' + blogs(ALL) + ')', 'accountid', BLOG_ORDER)}))""",
    "stream_upsert_posts": f"""with {pairs('delta', posts(ALL_POSTS), metrics(ALL_METRICS), False, LOWER, EXEC_DATE)},
    {latest_pairs('delta')} {show_merged('delta')}""",
}
