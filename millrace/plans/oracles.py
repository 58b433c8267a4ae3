"""The same results in SQL over the same tables, for comparison."""

_LANDED = """landed as (
  select event_id as id from events where event_id % 101 <> 0
  union all
  select event_id as id from events where event_id % 101 <> 0 and event_id % 103 = 0)"""

_CLEAN_AUDIT = """select count(*) as total, count(distinct event_id) as distinct_ids,
  cast(0 as bigint) as duplicates, cast(0 as bigint) as missing, cast(0 as bigint) as unexpected
from events"""

_USER_NAMES = "select event_id as id, printf('user-name-%09d', event_id) as user_name from events"

_SHARD_EVENTS = """select event_id as id, 'shard-' || lpad(cast(user_id % 2 as varchar), 3, '0') as shard_id
from events"""

_AFTER_LATEST = """from events e left join (
  select event_type, user_id % 2 as p, max(event_id) as mx from events
  where ts < timestamp '2024-01-15 00:00:00' group by event_type, user_id % 2) m
on e.event_type = m.event_type and e.user_id % 2 = m.p
where e.event_id > coalesce(m.mx, -1)"""

_SCHEMA_IDS = "select event_id as my_int, cast(event_id % 2 as integer) as p_schema_id"


_RECORDS = """select cast(event_id % 2 as integer) as p_schema_id, event_id as my_int,
  case when event_id % 2 = 0 then 'struct<my_int:bigint,at:timestamp,who:struct<user_id:bigint>>'
    else 'struct<my_int:int,kind:string,origin:string,note:string>' end as layout,
  case when event_id % 2 = 0 then epoch_us(ts) end as at_micros,
  case when event_id % 2 = 0 then user_id end as user_id,
  case when event_id % 2 = 1 then event_type end as kind,
  case when event_id % 2 = 1 then 'events' end as origin,
  cast(null as varchar) as note
from events"""


def _window(size: str) -> str:
    return f"""select time_bucket(interval '{size}', ts) as window_start, event_type, count(*) as n
from events group by all"""


ORACLES: dict[str, str] = {
    "user_names": _USER_NAMES,
    "names_projection": "select c_name from customer",
    "json_fields": "select event_id, cast(props->>'k' as bigint) as k from events",
    "utf8_defaults": """select event_id,
  coalesce(case when event_id % 97 = 0 then null else props end, '<no-val>') as v from events""",
    "drop_empty": "select event_id, props as v from events where event_id % 97 <> 0",
    "case_value": "select event_id, case when true then 'abc' end as my_col from events",
    "producer_records": """select 'raw' as topic, lpad(to_hex(event_id % 11), 16, '0') as key_hex,
  '{"id": ' || event_id || '}' as value from events""",
    "encoded_payloads": """with v as (
  select event_id, case when event_id % 2 = 0 then event_id else -event_id - 4611686018427387904 end as v from events),
z as (
  select event_id, v, case when v >= 0 then cast(v as hugeint) * 2 else cast(v as hugeint) * -2 - 1 end as z from v),
g as (
  select event_id, v, [z // cast(power(128, i) as hugeint) for i in range(11)] as g from z)
select event_id, v as decoded,
  array_to_string([printf('%02X', cast(g[i] % 128 + case when g[i + 1] > 0 then 128 else 0 end as integer))
    for i in range(1, 11) if i = 1 or g[i] > 0], '') as payload
from g""",
    "shard_events": _SHARD_EVENTS,
    "shard_writer": """with k as (select event_id as id, md5('0:' || event_id) as partition_key from events)
select id, partition_key,
  'shard-' || lpad(cast((cast('0x' || substr(md5(partition_key), 1, 8) as bigint) * 4) >> 32 as varchar), 3, '0')
    as shard_id
from k""",
    "start_at_timestamp": "select event_id from events where ts >= timestamp '2024-01-15 00:00:00'",
    "start_latest": f"select e.event_id {_AFTER_LATEST}",
    "log_manifest": """select 'shard-' || lpad(cast(user_id % 2 as varchar), 3, '0') as shard_id, count(*) as n,
  max(event_id) as last_id, epoch_us(min(ts)) as first_micros, epoch_us(max(ts)) as last_micros
from events group by user_id % 2""",
    "start_latest_files": """select e.event_id as id, 'shard-' || lpad(cast(e.user_id % 2 as varchar), 3, '0') as shard_id
from events e left join (
  select user_id % 2 as p, max(event_id) as mx from events where ts < timestamp '2024-01-15 00:00:00' group by user_id % 2) m
on e.user_id % 2 = m.p
where e.ts >= timestamp '2024-01-15 00:00:00' and e.event_id > coalesce(m.mx, -1)""",
    "window_5s": _window("5 seconds"),
    "window_10s": _window("10 seconds"),
    "window_60s": _window("60 seconds"),
    "schema_lookup": f"{_SCHEMA_IDS}, 'schema-' || (event_id % 2) as schema_name from events",
    "schema_rejects": """select event_id, event_id % 3 < 2 as schema_found,
  case when event_id % 3 < 2 then 'schema-' || (event_id % 3) end as schema_name from events""",
    "combine_per_key": """select event_id % 2 as schema_id, min(user_id) as least, cast(sum(user_id) as bigint) as total,
  bit_xor(user_id) as mixed from events group by event_id % 2""",
    "combine_per_key_with": """select event_type,
  list_reduce(list(cast(event_id % 997 + 1 as bigint)), lambda a, b: a * b % 1000003) as v
from events group by event_type""",
    "distinct_keys": "select distinct event_id % 2 as schema_id from events",
    "schema_map": "select distinct event_id % 2 as schema_id, 'schema-' || (event_id % 2) as schema_name from events",
    "count_and_distinct": "select count(*) as total, count(distinct event_id) as distinct_ids from events",
    "distinct_rows": "select count(*) as n from (select distinct user_id, event_type from events)",
    "rows_per_shard": "select user_id % 2 as shard, count(*) as n from events group by user_id % 2",
    "exactly_once_audit": f"""with {_LANDED}, c as (select id, count(*) as n from landed group by id)
select (select count(*) from landed) as total, (select count(*) from c) as distinct_ids,
  (select cast(sum(n - 1) as bigint) from c) as duplicates,
  (select count(*) from events e left join c on e.event_id = c.id where c.id is null) as missing,
  (select count(*) from c left join events e on e.event_id = c.id where e.event_id is null) as unexpected""",
    "stream_audit": """with sent as (select event_type as topic, event_id as id from events where event_id % 101 <> 0),
landed as (select * from sent union all select * from sent where id % 103 = 0),
c as (select topic, id, count(*) as n from landed group by topic, id),
e as (select distinct event_type as topic, event_id as id from events)
select coalesce(c.topic, e.topic) as topic, cast(sum(coalesce(n, 0)) as bigint) as total, count(c.id) as distinct_ids,
  cast(sum(coalesce(n - 1, 0)) as bigint) as duplicates, count(*) filter (c.id is null) as missing,
  count(*) filter (e.id is null) as unexpected
from e full join c on e.id = c.id and e.topic = c.topic group by 1""",
    "sequence_audit": """with seq as (select unnest(range((select count(*) from events))) as id)
select count(*) as total, count(distinct event_id) as distinct_ids,
  count(*) - count(distinct event_id) as duplicates,
  (select count(*) from seq where id not in (select event_id from events)) as missing,
  count(distinct event_id) filter (event_id not in (select id from seq)) as unexpected
from events""",
    "multiset_diff": f"""with {_LANDED}, expected as (select event_id as id from events),
missing as (select id from expected except all select id from landed),
extra as (select id from landed except all select id from expected)
select 'missing' as side, id, count(*) as copies from missing group by id
union all select 'extra' as side, id, count(*) as copies from extra group by id""",
    "topic_metrics": """select event_type as topic, cast(user_id % 2 as integer) as partition, count(*) as n,
  cast(0 as bigint) as null_keys, count(*) filter (event_id % 97 = 0) as null_values
from events group by event_type, user_id % 2""",
    "outbox_batches": """select user_id % 2 as bucket,
  cast((row_number() over (partition by user_id % 2 order by event_id) - 1) // 10 as bigint) as batch_no,
  cast(event_id as varchar) as body from events""",
    "outbox_copies": """select event_type as bucket, n // 10 as batch_no, event_type || '-' || n as message_id,
  cast(user_id as varchar) as body
from (select event_type, user_id, row_number() over (partition by event_type order by user_id) - 1 as n from events)""",
    "keyed_lines": "select cast(event_id % 11 as varchar) as key, props as value from events",
    "json_lines": "select event_id as id from events",
    "rows_per_day": "select strftime(ts, '%Y-%m-%d') as day, count(*) as n from events group by all",
    "days_batch": """select case when event_id % 97 <> 0 then strftime(ts, '%Y-%m-%d') end as day, count(*) as n
from events group by all""",
    "topic_window_files": """select event_type as topic,
  strftime(time_bucket(interval '10 seconds', ts), '%Y-%m-%dT%H-%M-%S') as window_start, count(*) as n
from events group by all""",
    "schema_id_files": """select event_id as my_int, cast(event_id % 2 as varchar) as p_schema_id
from events""",
    "schema_records": _RECORDS,
    "exact_shard_files": """select event_id % 2 as dest, count(*) as n, cast(3 as bigint) as files
from events group by event_id % 2""",
    "shared_shard_files": """with d as (
  select case when event_id % 3 = 0 then 'hot' when event_id % 50 = 1 then event_type else 'rest' end as dest from events),
n as (select dest, count(*) as n, cast(count(*) * 12 as double) / (select count(*) from d) as share from d group by dest),
busy as (
  select dest, floor(share) as whole, row_number() over (order by share - floor(share) desc, n desc) as turn,
    sum(share) over () - sum(floor(share)) over () as spare
  from n where share > 1)
select dest, n, cast(coalesce(whole + case when turn <= round(spare) then 1 else 0 end, 1) as bigint) as files
from n left join busy using (dest)""",
    "stream_shard_events": _SHARD_EVENTS,
    "stream_topics": "select event_type as topic, props as value from events where event_id % 97 <> 0",
    "stream_tap": "select event_type as topic, count(*) as n from events group by event_type",
    "stream_by_schema": f"{_SCHEMA_IDS} from events",
    "stream_schema_records": _RECORDS,
    "stream_admission": _CLEAN_AUDIT,
    "stream_start_latest": f"select e.event_id as id {_AFTER_LATEST}",
    "stream_start_at_timestamp": "select event_id as id from events where ts >= timestamp '2024-01-15 00:00:00'",
    "stream_reshard": """with s as (
  select event_id, 'shard-' || lpad(cast(user_id %
    case when event_id < (select count(*) // 2 from events) then 2 else 4 end as varchar), 3, '0') as shard_id
  from events)
select shard_id, count(*) as total, count(distinct event_id) as distinct_ids,
  cast(0 as bigint) as duplicates, cast(0 as bigint) as missing, cast(0 as bigint) as unexpected
from s group by shard_id""",
    "stream_crash_resume": _CLEAN_AUDIT,
    "stream_rescale": _CLEAN_AUDIT,
}
