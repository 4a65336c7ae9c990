"""Ego ticks derived from the ``events`` table: a clip for each 200 events of a user, commands held for 15 ticks and smoothed over 10."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_TEMPLATE = """
with n as (select user_id, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as int) as i, event_type,
  cast({json} as int) as k from events),
e as (select concat('clip_', case when i >= 200 then concat(cast(cast(floor(i / 200) as int) as {string}), 'b') else '' end, lpad(cast(user_id as {string}), 6, '0')) as clip_id, i % 200 as tick, event_type, k from n),
c as (select *, first_value(event_type) over (partition by clip_id, cast(floor(tick / 15) as int) order by tick) as bt,
  first_value(k) over (partition by clip_id, cast(floor(tick / 15) as int) order by tick) as bk from e),
d as (select clip_id, tick,
  avg(case bt when 'click' then 4.0e0 when 'view' then 3.0e0 when 'purchase' then 1.5e0 when 'signup' then 0.0e0 else -1.0e0 end)
    over (partition by clip_id order by tick rows between 9 preceding and current row) as s,
  sum((bk - 50) * 0.0004e0) over (partition by clip_id order by tick rows between unbounded preceding and current row) as h from c),
v as (select clip_id, 'ego' as agent_id, tick,
  round(s, 6) as s, round(h, 6) as heading from d)
select clip_id, agent_id, tick, round(s * cos(heading), 6) as vx, round(s * sin(heading), 6) as vy, heading,
  round(sum(s * cos(heading) * 0.1e0) over (partition by clip_id order by tick rows between unbounded preceding and current row), 4) as x,
  round(sum(s * sin(heading) * 0.1e0) over (partition by clip_id order by tick rows between unbounded preceding and current row), 4) as y
from v
"""

#: DuckDB rounds small negatives to -0.0, Spark to 0.0
SQL = re.sub(r", (\d)\) as ", r", \1) + 0.0e0 as ", _TEMPLATE.format(json="json_extract_string(props, '$.k')", string="varchar"))
SQL = SQL.replace("vy, heading,", "vy, heading + 0.0e0 as heading,")


def from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        _TEMPLATE.format(json="get_json_object(props, '$.k')", string="string").replace("from events", "from {events}", 1),
        events=spark.read.parquet(f"{sf_dir}/events.parquet"),
    )
