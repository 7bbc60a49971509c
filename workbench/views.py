"""Landed records derived from the given tables, as one SQL text for both engines.

``{EVENTS}``, ``{CONVERSATIONS}``, ``{MS}`` and ``{ISO}`` are the only parts that differ. The views
hold the input of a query only; what a query computes is written twice, in ``queries`` with the
library and in ``oracle`` in SQL. Conditions such as ``% 6`` choose which records are redelivered,
damaged, or missing from the archive that a pass finds; reads go over all messages.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

# A message of the wire as a row of the archive.
_STORED = """id, guild_id, channel_id, author_id, ms as created_at_ms,
    edited_raw_ms - edited_raw_ms % 1000 as edited_at_ms,
    case when content = '' then null else 'stored ' || content end as content, tts, pinned, kind,
    cast(flags as bigint) as flags, coalesce(mentions, '[]') as mentions, attachments, embeds,
    components, reactions, message_reference, raw_json"""

VIEWS: dict[str, str] = {
    "base": """
  select event_id, user_id, event_type, props, {MS} as ms from {EVENTS}
""",
    "one": """
  select
    (ms - 1420070400000) * 4194304 + event_id % 4194304 as id,
    1 + event_id % 12 % 3 as guild_id,
    100 + event_id % 12 as channel_id,
    user_id as author_id,
    'u' || cast(user_id as string) || '_v' || cast(event_id % 4 as string) as username,
    case when event_id % 3 = 0 then null else 'g' || cast(user_id as string) end as global_name,
    case when user_id % 7 = 0 then null when user_id % 3 = 0 then '0'
      else '00' || cast(user_id as string) end as discriminator,
    case when user_id % 5 = 0 then null else 'a_' || cast(event_id % 4 as string) end as avatar,
    case when user_id % 13 = 0 then null else user_id % 10 = 0 end as bot,
    case when event_type = 'error' and event_id % 4 = 0 then 900 + user_id end as webhook_id,
    case when event_id % 7 = 0 then ms + 1500 end as edited_raw_ms,
    case when event_id % 5 = 0 then '' when event_id % 95 = 1 then ' '
      else event_type || ' ' || props end as content,
    event_id % 33 = 0 as tts,
    event_id % 50 = 0 as pinned,
    case when event_id % 4 = 1 then event_type else cast(event_id % 45 as string) end as kind,
    case when event_id % 9 = 0 then 4 end as flags,
    case when event_id % 3 = 0 then '[{"id":"' || cast((user_id + 1) % 150 as string)
      || '"},{"id":"' || cast((user_id + 2) % 150 as string) || '"}]'
      when event_id % 17 = 0 then null else '[]' end as mentions,
    case when event_id % 8 = 0 then '[{"id":"a' || cast(event_id as string) || '","size":'
      || cast(event_id % 100 as string) || '}]' else '[]' end as attachments,
    case when event_id % 10 = 0 then '[{"title":"' || event_type || '"}]' else '[]' end as embeds,
    case when event_id % 14 = 0 then '[{"type":1}]' else '[]' end as components,
    case when event_id % 6 = 0 then '[{"emoji":"x","count":' || cast(event_id % 9 as string)
      || '}]' else '[]' end as reactions,
    case when event_id % 16 = 0 then '{"message_id":"' || cast(event_id as string) || '"}' end
      as message_reference,
    event_id as arrival_seq, ms
  from base
""",
    "deliveries": """
  select * from one
  union all
  select id, guild_id, channel_id, author_id, username || 'x', null, discriminator, avatar, bot,
    webhook_id, edited_raw_ms, 'redelivered ' || content, tts, not pinned, kind, flags, mentions,
    attachments, embeds, components, reactions, message_reference, arrival_seq + 1000000000000000, ms
  from one where arrival_seq % 6 = 0
""",
    "authored": """
  select *,
    '{"id":"' || cast(author_id as string) || '","username":"' || username || '"'
      || coalesce(',"global_name":"' || global_name || '"', '')
      || coalesce(',"discriminator":"' || discriminator || '"', '')
      || coalesce(',"avatar":"' || avatar || '"', '')
      || case when bot is null then '' when bot then ',"bot":true' else ',"bot":false' end
      || '}' as author_json
  from deliveries
""",
    "wire": """
  select *,
    '{"id":"' || cast(id as string) || '","guild_id":"' || cast(guild_id as string)
      || '","channel_id":"' || cast(channel_id as string) || '","author":' || author_json
      || coalesce(',"webhook_id":"' || cast(webhook_id as string) || '"', '')
      || coalesce(',"edited_timestamp":"' || {ISO} || '"', '')
      || ',"content":"' || replace(content, '"', chr(92) || '"') || '"'
      || ',"tts":' || case when tts then 'true' else 'false' end
      || ',"pinned":' || case when pinned then 'true' else 'false' end
      || ',"kind":"' || kind || '"' || coalesce(',"flags":' || cast(flags as string), '')
      || coalesce(',"mentions":' || mentions, '') || ',"attachments":' || attachments
      || ',"embeds":' || embeds || ',"components":' || components || ',"reactions":' || reactions
      || coalesce(',"message_reference":' || message_reference, '')
      || ',"arrival_seq":' || cast(arrival_seq as string) || '}' as raw_json
  from authored
""",
    "dirty": """
  select *,
    case
      when arrival_seq % 97 = 5 then substr(raw_json, 1, length(raw_json) - 9)
      when arrival_seq % 89 = 7 then replace(raw_json, '{"id":"' || cast(id as string) || '"',
        '{"id":"9223372036854775808"')
      when arrival_seq % 83 = 11 then replace(raw_json, '"author":' || author_json, '"author":null')
      else raw_json end as line
  from wire
""",
    "guild_base": """
  select 1 + event_id % 12 % 3 as id, count(*) as members from base group by 1
""",
    "guild_wire": """
  select *, '{"id":"' || cast(id as string) || '","name":"' || name || '","owner_id":"'
    || cast(owner_id as string) || '"' || coalesce(',"icon":"' || icon || '"', '')
    || coalesce(',"features":' || features, '') || ',"members":' || cast(members as string)
    || ',"arrival_seq":' || cast(arrival_seq as string) || '}' as raw_json
  from (
    select id, 'guild ' || cast(id as string) as name, 5000 + id as owner_id,
      'icon' || cast(id as string) as icon, '["F' || cast(id as string) || '"]' as features,
      members, cast(1 as bigint) as arrival_seq from guild_base
    union all
    select id, 'guild ' || cast(id as string) || ' renamed', 6000 + id, null,
      case when id = 2 then null else '["F","G"]' end, members, cast(2 as bigint)
    from guild_base where id <> 1
  ) versions
""",
    "guild_stored": """
  select id, 'stored ' || cast(id as string) as name, 1 + id as owner_id, 'old' as icon,
    '[]' as features, '{}' as raw_json, cast(0 as bigint) as arrival_seq
  from guild_base where id < 3
  union all
  select 77, 'gone', null, 'old', '[]', '{}', cast(0 as bigint)
  union all
  select id, 'newer than the wire', id, null, '[]', '{}', cast(99 as bigint) from guild_base where id = 3
""",
    "channel_base": """
  select 100 + event_id % 12 as id, min(1 + event_id % 12 % 3) as guild_id, count(*) as traffic
  from base group by 1
""",
    "channel_wire": """
  select *, '{"id":"' || cast(id as string) || '","guild_id":"' || cast(guild_id as string)
    || '","name":"' || name || '","kind":"' || kind || '"' || coalesce(',"topic":"' || topic || '"', '')
    || case when nsfw is null then '' when nsfw then ',"nsfw":true' else ',"nsfw":false' end
    || coalesce(',"parent_id":"' || cast(parent_id as string) || '"', '')
    || coalesce(',"position":' || cast(position as string), '')
    || ',"traffic":' || cast(traffic as string) || ',"arrival_seq":' || cast(arrival_seq as string)
    || '}' as raw_json
  from (
    select id, guild_id, 'c' || cast(id as string) as name,
      case id % 8 when 0 then '0' when 1 then 'News' when 2 then '11' when 3 then 'PrivateThread'
        when 4 then '10' when 5 then 'Forum' when 6 then '2' else 'Category' end as kind,
      'topic ' || cast(id as string) as topic,
      case when id % 4 = 1 then null else id % 5 = 0 end as nsfw,
      case when id % 3 = 1 then 50 + guild_id end as parent_id,
      case when id % 5 = 3 then null else cast(id % 12 as int) end as position,
      traffic, cast(1 as bigint) as arrival_seq
    from channel_base
    union all
    select id, guild_id, 'c' || cast(id as string) || '-renamed',
      case id % 8 when 0 then '0' when 1 then 'News' when 2 then '11' when 3 then 'PrivateThread'
        when 4 then '10' when 5 then 'Forum' when 6 then '2' else 'Category' end,
      null, id % 5 = 0, null, cast(id % 7 as int), traffic, cast(2 as bigint)
    from channel_base where id % 3 = 0
  ) versions
""",
    "channel_lines": """
  select *, case when id % 11 = 2 and arrival_seq = 1 then replace(raw_json, '{"id":"',
    '{"id":"x') else raw_json end as line
  from channel_wire
""",
    "channel_stored": """
  select id, 9 as guild_id, 'old' as name, 'Text' as kind, 'old topic' as topic, false as nsfw,
    9 as parent_id, cast(9 as int) as position, '{}' as raw_json, cast(0 as bigint) as arrival_seq
  from channel_base where id % 2 = 0
""",
    "users_target": """
  select distinct user_id as id, 'old' || cast(user_id as string) as username, 'old' as global_name,
    '1' as discriminator, 'old' as avatar, false as bot, '{}' as raw_json,
    cast(case when user_id % 8 = 0 then 9000000000000000 else -1 end as bigint) as arrival_seq
  from base where user_id % 4 = 0
  union all
  select -1, 'gone', 'old', null, null, false, '{}', cast(-1 as bigint)
""",
    "spoken": """
  select conv_id * 1048576 + turn as id, conv_id as channel_id, role <> 'user' as bot, text as content,
    turn as arrival_seq
  from {CONVERSATIONS}
""",
    "all_pick": """
  select * from wire
  where arrival_seq < 1000000000000000 and not coalesce(bot, false) and webhook_id is null
""",
    # The archive a pass starts from: the middle of the time range without each 11th and without one
    # channel, with another content than the wire, so that a stored row that was replaced shows.
    "stored_pick": """
  select * from all_pick
  where ms >= 1704672000000 and ms < 1705968000000 and arrival_seq % 11 <> 0 and channel_id <> 105
""",
    "archive": f"""
  select {_STORED} from stored_pick
""",
    # An archive that holds every message.
    "all_messages": f"""
  select {_STORED} from all_pick
""",
}


MESSAGE_COLUMNS = (
    "id, guild_id, channel_id, author_id, created_at_ms, edited_at_ms, content, tts, pinned, kind, "
    "flags, mentions, attachments, embeds, components, reactions, message_reference, raw_json"
)

SPARK = {
    "MS": "unix_millis(cast(ts as timestamp))",
    "ISO": "date_format(timestamp_millis(edited_raw_ms), \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
}
DUCKDB = {
    "EVENTS": "events",
    "CONVERSATIONS": "conversations",
    "MS": "epoch_us(ts) // 1000",
    "ISO": "strftime(make_timestamp(edited_raw_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')",
}


def _bind(text: str, values: dict[str, str]) -> str:
    return re.sub(r"\{(EVENTS|CONVERSATIONS|MS|ISO)\}", lambda hit: values[hit.group(1)], text)


def _with(names: Iterable[str], values: dict[str, str]) -> str:
    """``with`` text of the named views and the views they read, in the order of definition."""
    needed: set[str] = set()
    open_names = list(names)
    while open_names:
        name = open_names.pop()
        if name not in needed:
            needed.add(name)
            open_names += [word for word in re.findall(r"\w+", VIEWS[name]) if word in VIEWS]
    parts = [f"{name} as ({_bind(body, values)})" for name, body in VIEWS.items() if name in needed]
    return "with " + ", ".join(parts) + " "


def spark_views(sf_dir: str, *names: str) -> str:
    """The named views over the Parquet files of ``sf_dir``."""
    tables = {
        "EVENTS": f"parquet.`{sf_dir}/events.parquet`",
        "CONVERSATIONS": f"parquet.`{sf_dir}/conversations.parquet`",
    }
    return _with(names, {**SPARK, **tables})


def duckdb_views() -> str:
    """All views over the tables registered in DuckDB."""
    return _with(VIEWS, DUCKDB)
