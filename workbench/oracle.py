"""The queries once more, in SQL for DuckDB."""

from __future__ import annotations

from palaver.functions.kinds import CHANNEL_KINDS, MESSAGE_KINDS
from workbench.queries import GUILD_CURSOR, PAGED_CHANNEL, SEARCH_PATTERN, SEARCH_TEXT, SPOKEN_TEXT
from workbench.views import MESSAGE_COLUMNS, duckdb_views

HUMAN = "not coalesce(bot, false) and webhook_id is null"
BEARING = "('Text', 'News', 'PublicThread', 'PrivateThread', 'NewsThread', 'Forum')"
GOOD = """not (arrival_seq % 97 = 5 or arrival_seq % 89 = 7 or arrival_seq % 83 = 11)"""
GOOD_CHANNEL = "not (id % 11 = 2 and arrival_seq = 1)"
LISTS = ("mentions", "attachments", "embeds", "components", "reactions")


def _names(table: dict[int, str]) -> str:
    return ", ".join(f"({code}, '{name}')" for code, name in table.items())


STEPS = f"""
, message_names(code, label) as (values {_names(MESSAGE_KINDS)}
), channel_names(code, label) as (values {_names(CHANNEL_KINDS)}
), message_rows as (
  select w.id, guild_id, channel_id, author_id, (w.id >> 22) + 1420070400000 as created_at_ms,
    (edited_raw_ms // 1000) * 1000 as edited_at_ms,
    case when content <> '' then content end as content, tts, pinned,
    case when try_cast(kind as int) is null then kind
      else coalesce(label, 'Unknown(' || kind || ')') end as kind,
    cast(flags as bigint) as flags, coalesce(mentions, '[]') as mentions, attachments, embeds,
    components, reactions, message_reference, raw_json, arrival_seq, bot, webhook_id
  from wire w left join message_names n on n.code = try_cast(w.kind as int)
), human_rows as (
  select * exclude (bot, webhook_id) from message_rows where {HUMAN}
), user_rows as (
  select author_id as id, username, global_name,
    cast(nullif(try_cast(discriminator as int), 0) as varchar) as discriminator, avatar,
    coalesce(bot, false) as bot, author_json as raw_json, arrival_seq, id as message_id, channel_id
  from wire where {HUMAN}
), guild_rows as (
  select id, name, owner_id, icon, coalesce(features, '[]') as features, raw_json, arrival_seq
  from guild_wire
), channel_rows as (
  select id, guild_id, name,
    case when try_cast(kind as int) is null then kind
      else coalesce(label, 'Unknown(' || kind || ')') end as kind,
    topic, coalesce(nsfw, false) as nsfw, parent_id, position, raw_json, arrival_seq
  from channel_wire w left join channel_names n on n.code = try_cast(w.kind as int)
), walk as (
  select distinct id as channel_id, guild_id as walk_guild_id from channel_rows where kind in {BEARING}
), source as (
  select id, channel_id, author_id, content, bot, webhook_id from wire
  qualify row_number() over (partition by id order by arrival_seq) = 1
), human_source as (
  select id, channel_id, author_id, content, arrival_seq from wire where {HUMAN}
  qualify row_number() over (partition by id order by arrival_seq) = 1
), bounds as (
  select channel_id, min(id) as lo, max(id) as hi from archive group by channel_id
)
"""

FIRST = "qualify row_number() over (partition by id order by arrival_seq) = 1"
LAST = "qualify row_number() over (partition by id order by arrival_seq desc) = 1"
ROW = "id, channel_id, author_id, content, arrival_seq"
MESSAGE_ROW = f"{MESSAGE_COLUMNS}, arrival_seq"
GUILD_ROW = "id, name, owner_id, icon, features, raw_json, arrival_seq"
CHANNEL_ROW = (
    "id, guild_id, name, kind, topic, nsfw, parent_id, position, raw_json, arrival_seq"
)
USER_ROW = "id, username, global_name, discriminator, avatar, bot, raw_json, arrival_seq"

LANDED_GUILD = """select cast(id as varchar) as id, name, cast(owner_id as varchar) as owner_id, icon,
  features, raw_json, arrival_seq from guild_wire"""
LANDED_CHANNEL = f"""select cast(id as varchar) as id, cast(guild_id as varchar) as guild_id, name,
  kind, topic, nsfw, cast(parent_id as varchar) as parent_id, position, line as raw_json, arrival_seq
  from channel_lines where {GOOD_CHANNEL}"""
LANDED_MESSAGE = f"""select cast(id as varchar) as id, cast(guild_id as varchar) as guild_id,
  cast(channel_id as varchar) as channel_id, cast(author_id as varchar) as author_id,
  cast(webhook_id as varchar) as webhook_id, edited_raw_ms, cast(flags as bigint) as flags, username,
  global_name, discriminator, avatar, bot, author_json, content, tts, pinned, kind, mentions,
  attachments, embeds, components, reactions, message_reference, arrival_seq, line as raw_json
  from dirty where {GOOD}"""

STORED_STREAM = f"""select {MESSAGE_COLUMNS} from archive
  union all select {MESSAGE_COLUMNS} from (
    select {MESSAGE_ROW} from human_rows
    where {GOOD} and id not in (select id from archive) {FIRST}) fresh"""


def _pages(rows: str, columns: str, order: str, limit: int = 100) -> str:
    return f"""select {columns} from ({rows}) picked
      qualify row_number() over (partition by channel_id order by id {order}) <= {limit}"""


QUERIES: dict[str, str] = {
    "scan_guilds": LANDED_GUILD,
    "scan_channels": LANDED_CHANNEL,
    "scan_messages": LANDED_MESSAGE,
    "stream_messages": LANDED_MESSAGE,
    "scan_conversations": """select cast(id as varchar) as id, cast(channel_id as varchar) as channel_id,
      cast(channel_id as varchar) as author_id, bot, content, arrival_seq from spoken""",
    "quarantine_counts": f"""
      select 'channels' as feed, 'bad_id' as reject_reason, count(*) as rejected
      from channel_lines where not ({GOOD_CHANNEL}) having count(*) > 0
      union all
      select 'messages', case when arrival_seq % 97 = 5 then 'malformed'
        when arrival_seq % 89 = 7 then 'bad_id' else 'bad_author_id' end, count(*)
      from dirty where not ({GOOD}) group by all""",
    "bootstrap_tables": f"""
      select 'guilds' as table_name, cast(0 as bigint) as rows_created,
        count(distinct id) as rows_loaded from guild_rows
      union all select 'channels', 0, count(distinct id) from channel_rows where kind in {BEARING}
      union all select 'users', 0, count(distinct id) from user_rows
      union all select 'messages', 0, count(distinct id) from human_rows""",
    "guild_upsert": f"""select {GUILD_ROW} from (
      select {GUILD_ROW} from guild_rows union all select {GUILD_ROW} from guild_stored) x {LAST}""",
    "channel_upsert": f"""select {CHANNEL_ROW} from (
      select {CHANNEL_ROW} from channel_rows where kind in {BEARING}
      union all select {CHANNEL_ROW} from channel_stored) x {LAST}""",
    "users_batch_upsert": f"""select {USER_ROW} from (
      select {USER_ROW} from user_rows union all select {USER_ROW} from users_target) x {LAST}""",
    "user_upsert_stream": f"""select {USER_ROW} from (
      select {USER_ROW} from user_rows where {GOOD}
      union all select {USER_ROW} from users_target) x {LAST}""",
    "messages_insert_ignore": f"""select {MESSAGE_COLUMNS} from archive
      union all select {MESSAGE_COLUMNS} from (
        select {MESSAGE_ROW} from human_rows where id not in (select id from archive) {FIRST}) fresh""",
    "message_insert_stream": STORED_STREAM,
    "incremental_pass": STORED_STREAM,
    "live_messages": f"""select {MESSAGE_COLUMNS} from (
      select {MESSAGE_ROW} from human_rows where {GOOD} {FIRST}) x""",
    "live_users": f"select {USER_ROW} from user_rows where {GOOD} {LAST}",
    "guild_projection": f"select {GUILD_ROW} from guild_rows",
    "channel_projection": f"select {CHANNEL_ROW} from channel_rows",
    "user_projection": f"select {USER_ROW}, message_id from user_rows",
    "message_projection": f"""select * replace (cast(7 as bigint) as guild_id) from (
      select {MESSAGE_ROW} from human_rows) x""",
    "message_projection_live": f"select {MESSAGE_ROW} from human_rows",
    "snowflake_created_at": """select id, arrival_seq, ms as created_at_ms,
      strftime(make_timestamp(ms * 1000), '%Y-%m-%d') as created_date from wire""",
    "edited_at_seconds": """select id, arrival_seq, edited_raw_ms - edited_raw_ms % 1000 as edited_at_ms
      from wire""",
    "content_empty_to_null": """select id, arrival_seq, nullif(content, '') as content from wire""",
    "kind_name": "select id, arrival_seq, kind from message_rows",
    "discriminator_text": """select id, arrival_seq, case when author_id % 7 = 0 then null
      when author_id % 3 = 0 then null else cast(author_id as varchar) end as discriminator from wire""",
    "json_capture": """select id, arrival_seq, mentions, attachments, embeds, components, reactions
      from message_rows""",
    "human_author_filter": f"""select cast(id as varchar) as id, cast(author_id as varchar) as author_id,
      bot, arrival_seq from wire where {HUMAN}""",
    "conversation_human_filter": "select id, channel_id, content from spoken where not bot",
    "message_bearing_channels": f"select {CHANNEL_ROW} from channel_rows where kind in {BEARING}",
    "users_dedup_last": f"select {USER_ROW}, message_id from user_rows {LAST}",
    "messages_dedup_first": f"select {MESSAGE_ROW} from human_rows {FIRST}",
    "page_latest": f"""select id, channel_id, author_id, content from source
      where channel_id = {PAGED_CHANNEL} order by id desc limit 100""",
    "page_before": f"""select id, channel_id, author_id, content from source
      where channel_id = {PAGED_CHANNEL}
        and id < (select min(id) from archive where channel_id = {PAGED_CHANNEL})
      order by id desc limit 100""",
    "page_after": f"""select id, channel_id, author_id, content from source
      where channel_id = {PAGED_CHANNEL}
        and id > (select max(id) from archive where channel_id = {PAGED_CHANNEL})
      order by id limit 100""",
    "guild_page_after": f"""select {GUILD_ROW} from (select * from guild_rows {LAST}) x
      where id > {GUILD_CURSOR} order by id limit 200""",
    "page_latest_all": _pages("from source select *", "id, channel_id, author_id, content", "desc"),
    "page_before_all": _pages(
        "select s.* from source s left join bounds b using (channel_id) where lo is null or id < lo",
        "id, channel_id, author_id, content",
        "desc",
    ),
    "page_after_all": _pages(
        "select s.* from source s join bounds b using (channel_id) where id > hi",
        "id, channel_id, author_id, content",
        "asc",
    ),
    "conversation_page_latest_all": _pages("select * from spoken", "id, channel_id, content", "desc", 3),
    "channel_max_id": "select channel_id, max(id) as max_id from all_messages group by channel_id",
    "channel_min_id": "select channel_id, min(id) as min_id from all_messages group by channel_id",
    "processed_counts": f"""select channel_id, backfill_processed, catch_up_processed, sweep_processed,
        backfill_processed + catch_up_processed + sweep_processed as processed, inserted
      from (
        select s.channel_id, count(*) filter (where lo is null or s.id < lo) as backfill_processed,
          count(*) filter (where s.id > hi) as catch_up_processed, count(*) as sweep_processed,
          count(*) filter (where s.id not in (select id from archive)) as inserted
        from source s left join bounds b using (channel_id) where {HUMAN} group by s.channel_id) x""",
    "page_counts": """select channel_id, cast(n as bigint) as source_rows,
        cast(ceil(below / 100.0) as bigint) as backfill_pages,
        cast(ceil(above / 100.0) as bigint) as catch_up_pages, cast(ceil(n / 100.0) as bigint) as sweep_pages
      from (
        select s.channel_id, count(*) as n, count(*) filter (where lo is null or s.id < lo) as below,
          count(*) filter (where s.id > coalesce(hi, newest)) as above
        from source s left join bounds b using (channel_id)
        left join (select channel_id, max(id) as newest from human_source group by channel_id) h using (channel_id)
        group by s.channel_id) x""",
    "channel_counts": f"""select guild_id, count(*) as channels,
        count(*) filter (where kind in {BEARING}) as message_bearing
      from (select * from channel_rows {LAST}) x group by guild_id""",
    "guild_counts": f"""select count(*) as guilds_listed, count(*) filter (where id not in (
        select guild_id from channel_lines group by guild_id having not bool_or({GOOD_CHANNEL}))) as guilds_processed
      from (select distinct id from guild_wire) g""",
    "backfill_rows": f"""select {ROW} from human_source left join bounds using (channel_id)
      where lo is null or id < lo""",
    "catch_up_rows": f"select {ROW} from human_source join bounds using (channel_id) where id > hi",
    "interior_gap_rows": f"""select {ROW} from human_source join bounds using (channel_id)
      where id > lo and id < hi and id not in (select id from archive)""",
    "missing_messages_labelled": f"""select {ROW}, case when lo is null or id < lo then 'backfill'
        when id > hi then 'catch_up' else 'interior' end as phase
      from human_source left join bounds using (channel_id)
      where not exists (select 1 from archive a where a.id = human_source.id)""",
    "sync_pass_guilds": f"""select {GUILD_ROW} from (
      select {GUILD_ROW} from guild_stored union all select {GUILD_ROW} from guild_rows) x {LAST}""",
    "sync_pass_channels": f"""select {CHANNEL_ROW} from (
      select {CHANNEL_ROW} from channel_stored
      union all select {CHANNEL_ROW} from channel_rows where kind in {BEARING}) x {LAST}""",
    "sync_pass_users": f"""select {USER_ROW} from (
      select {USER_ROW} from user_rows where channel_id in (select channel_id from walk)
      union all select {USER_ROW} from users_target) x {LAST}""",
    "sync_pass_messages": f"""select {MESSAGE_COLUMNS} from archive
      union all select {MESSAGE_COLUMNS} from (
        select * replace (walk_guild_id as guild_id) from human_rows join walk using (channel_id)
        where id not in (select id from archive) {FIRST}) fresh""",
    "polled_passes": f"""select {MESSAGE_COLUMNS} from archive
      union all select {MESSAGE_COLUMNS} from (
        select * replace (walk_guild_id as guild_id) from human_rows join walk using (channel_id)
        where {GOOD} and id not in (select id from archive) {FIRST}) fresh""",
    "stored_messages": f"select {MESSAGE_COLUMNS} from all_messages",
    "stored_bounds": "select channel_id, min(id) as lo, max(id) as hi, count(*) as n from all_messages group by channel_id",
    "stored_page_latest": f"""select id, channel_id, author_id, content from all_messages
      where channel_id = {PAGED_CHANNEL} order by id desc limit 100""",
    "stored_page_before": f"""select id, channel_id, author_id, content from all_messages
      where channel_id = {PAGED_CHANNEL}
        and id < (select max(id) from all_messages where channel_id = {PAGED_CHANNEL}) order by id desc limit 100""",
    "stored_page_after": f"""select id, channel_id, author_id, content from all_messages
      where channel_id = {PAGED_CHANNEL}
        and id > (select min(id) from all_messages where channel_id = {PAGED_CHANNEL}) order by id limit 100""",
    "stored_missing": f"""select {ROW.replace("content", "nullif(content, '') as content")} from human_source
      where not exists (select 1 from archive a where a.id = human_source.id)""",
    "channel_timeline": """select channel_id, created_at_ms, id, author_id, content from all_messages
      order by channel_id, created_at_ms, id""",
    "author_history": """select author_id, created_at_ms, id, channel_id, content from all_messages
      order by author_id, created_at_ms, id""",
    **{
        f"message_{column}": f"""select message_id, channel_id,
            cast(position as int) - 1 as position, cast(element as varchar) as element from (
          select id as message_id, channel_id, unnest(cast({column} as json[])) as element,
            unnest(range(1, len(cast({column} as json[])) + 1)) as position from all_messages) x"""
        for column in LISTS
    },
    "message_replies": """select id, channel_id, message_reference from all_messages
      where message_reference is not null""",
    "content_search": f"""select id, channel_id, author_id, content from all_messages
      where contains(content, '{SEARCH_TEXT}') and regexp_matches(content, '{SEARCH_PATTERN}')""",
    "conversation_content_search": f"""select id, channel_id, content from spoken
      where contains(content, '{SPOKEN_TEXT}')""",
}

for _table in ("guilds", "channels", "users", "messages"):
    QUERIES[f"written_pass_{_table}"] = QUERIES[f"sync_pass_{_table}"]


def oracle_sql() -> dict[str, str]:
    return {name: duckdb_views() + STEPS + sql for name, sql in QUERIES.items()}
