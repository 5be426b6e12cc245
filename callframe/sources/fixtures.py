"""Derived input tables.

Each fixture is one SQL statement over the driver's tables that runs
unchanged in Spark and in DuckDB, so the Spark job and the DuckDB oracle
start from identical rows. Tables and other fixtures are written ``@name``;
Spark binds them to session-local temp views over the Parquet files, the oracle
to its pre-registered views and common table expressions.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from callframe.sources.tables import dealt, read_table

# Flat-format rows with one model output each (FIXTURES.md "records").
RECORDS = """
WITH b AS (
  SELECT event_id, event_type, value, user_id, props,
         event_id % 12 AS v,
         CAST(floor(event_id / 12) AS BIGINT) % 5 AS neg,
         CAST(user_id AS STRING) AS uid,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM @events),
c AS (
  SELECT *,
    '[{"name":"'||event_type||'","arguments":{"user_id":'||uid AS head,
    ',"cents":'||CAST(cents AS STRING)||',"props":'||props AS tail,
    '{"user_id":'||uid||',"cents":'||CAST(cents AS STRING)||',"props":'||props||'}' AS args
  FROM b)
SELECT event_id AS record_id,
  'Log '||event_type||' for user '||uid AS query,
  '[{"name":"click"},{"name":"view"},{"name":"purchase","parameters":{"type":"object","required":["user_id","cents"]}},{"name":"signup"},{"name":"error"},{"name":"aux_'||uid||'"}]' AS tools,
  CASE WHEN neg = 0 THEN '[]' ELSE head||tail||'}}]' END AS answers,
  CASE
    WHEN v <= 4 THEN '<thought>t</thought>'||chr(10)||'<tool_call>'||chr(10)||head||tail||'}}]'||chr(10)||'</tool_call>'
    WHEN v = 5 THEN '<tool_call>{"name": </tool_call>'
    WHEN v = 6 THEN '<TOOL_CALL>[{"name":"no_such_tool","arguments":'||args||'}]</TOOL_CALL>'
    WHEN v = 7 THEN '<tool_call>'||head||tail||',"extra":1}}]</tool_call>'
    WHEN v = 8 THEN '<tool_call>'||head||'}}]</tool_call>'
    WHEN v = 9 THEN '<tool_call>'||head||',"cents":"'||CAST(cents AS STRING)||'","props":'||props||'}}]</tool_call>'
    WHEN v = 10 THEN '<tool_call>'||head||',"cents":'||CAST(cents + 1 AS STRING)||',"props":'||props||'}}]</tool_call>'
    ELSE '<thought>4. Validation: [Abort: No matching tool]</thought>'
  END AS raw_response,
  value AS latency_ms,
  user_id AS generated_tokens
FROM c
"""

# Conversations with calls, long form (FIXTURES.md "turns").
TURNS = """
SELECT conv_id, turn,
  CASE WHEN role = 'assistant' AND conv_id % 4 = 0 THEN 'function_call' ELSE role END AS role,
  CASE
    WHEN role = 'assistant' AND conv_id % 4 IN (0, 3) AND turn % 4 = 3 THEN 'not json'
    WHEN role = 'assistant' AND conv_id % 4 = 0 THEN '[{"name":"f","arguments":{"n":'||CAST(turn AS STRING)||'}}]'
    WHEN role = 'assistant' AND conv_id % 4 = 1 THEN 'ok <tool_call>{"name":"g","arguments":{"n":'||CAST(turn AS STRING)||'}}</tool_call>'
    WHEN role = 'assistant' AND conv_id % 4 = 3 THEN 'calls [{"name":"h","arguments":{"n":'||CAST(turn AS STRING)||'}}] done'
    ELSE text
  END AS content
FROM @conversations
"""

# Inventory items with rule breaks (FIXTURES.md "items").
ITEMS = """
SELECT
  CASE WHEN p_partkey % 50 = 2 THEN 'X' ELSE 'ITEM-'||lpad(CAST(p_partkey AS STRING), 7, '0') END AS item_code,
  CASE WHEN p_partkey % 50 = 3 THEN '' ELSE p_name END AS name,
  CASE WHEN p_partkey % 50 = 0 THEN 0.0 ELSE p_retailprice END AS cost,
  CASE WHEN p_partkey % 50 = 1 THEN -1 ELSE p_size END AS quantity,
  p_partkey AS item_order
FROM @part
"""

# Tool calls to execute (FIXTURES.md "inventory_calls").
INVENTORY_CALLS = """
SELECT event_id AS call_id,
  CASE
    WHEN event_id % 23 = 0 THEN '[]'
    WHEN event_id % 23 = 1 THEN 'not json'
    WHEN event_id % 23 = 2 THEN '[{"name":"inventory_check","arguments":{"item_codes":null}}]'
    WHEN event_id % 23 = 3 THEN '[{"name":"inventory_check","arguments":{"item_codes":null,"conversion_rate":0.1234567}}]'
    WHEN event_id % 23 = 4 THEN '[{"name":"say '||chr(92)||'"hi'||chr(92)||'"","arguments":{"n":1}}]'
    WHEN event_id % 4 = 0 THEN '[{"name":"inventory_check","arguments":{"item_codes":null,"conversion_rate":0.5}}]'
    WHEN event_id % 4 = 1 THEN '[{"name":"inventory_check","arguments":{"item_codes":[],"conversion_rate":0.25}}]'
    WHEN event_id % 4 = 2 THEN '[{"name":"inventory_check","arguments":{"item_codes":["ITEM-'||lpad(CAST(user_id AS STRING), 7, '0')||'","ITEM-0000007","ITEM-0000007"],"conversion_rate":2}}]'
    ELSE '[{"name":"fetch_item_by_name","arguments":{"item_name":"'||CASE WHEN event_id % 8 = 3 THEN 'blue bolt' ELSE 'no such item' END||'"}},{"name":"inventory_check","arguments":{"item_codes":null,"conversion_rate":0.5}}]'
  END AS calls
FROM @events
"""

# Training log (FIXTURES.md "loss_log").
LOSS_LOG = """
SELECT user_id AS run_id, event_id AS step, ts,
  CASE WHEN event_id % 97 = 0 THEN CAST('NaN' AS DOUBLE)
       WHEN event_id % 101 = 0 THEN CAST('Infinity' AS DOUBLE)
       ELSE value END AS loss
FROM @events
"""

# Raw flat rows with broken ones mixed in, to exercise the record contract:
# tools an object, tools not JSON, a non-object tool, a NULL query, NULL
# answers, answers as a JSON object, answers cut off. Some queries are in no
# other table, some tools differ from others of their name.
FLAT_ROWS = """
SELECT event_id AS row_id,
  CASE WHEN event_id % 17 = 3 THEN NULL
       WHEN event_id % 5 = 1 THEN 'Show '||event_type||' of user '||CAST(user_id AS STRING)
       ELSE 'Log '||event_type||' for user '||CAST(user_id AS STRING) END AS query,
  CASE
    WHEN event_id % 17 = 0 THEN '{"name":"click"}'
    WHEN event_id % 17 = 1 THEN 'not json'
    WHEN event_id % 17 = 2 THEN '[1,{"name":"'||event_type||'"}]'
    WHEN event_id % 17 IN (6, 7, 8, 9) THEN '[{"name":"'||event_type||'","parameters":{"type":"object","required":["user_id"]}}]'
    WHEN event_id % 17 = 10 THEN '[{"name":"'||event_type||'","description":"again","parameters":{"type":"object","required":["user_id","cents"]}}]'
    WHEN event_id % 17 = 11 THEN '[{"name":"'||event_type||'","parameters":{"type":"array","required":["user_id"]}}]'
    ELSE '[{"name":"'||event_type||'","parameters":{"type":"object","required":["user_id"]}},{"type":"function","function":{"name":"lookup"}}]'
  END AS tools,
  CASE
    WHEN event_id % 17 = 4 THEN NULL
    WHEN event_id % 17 = 5 THEN '{"name":"'||event_type||'","arguments":{"user_id":'||CAST(user_id AS STRING)||'}}'
    WHEN event_id % 17 = 12 THEN '[{"name":"'||event_type
    WHEN event_id % 3 = 0 THEN '[]'
    ELSE '[{"name":"'||event_type||'","arguments":{"user_id":'||CAST(user_id AS STRING)||'}}]'
  END AS answers
FROM @events
"""

# Records as JSON lines; some lines are cut off, are no objects, or hold a
# value of another type.
JSON_LINES = """
SELECT event_id AS line_no,
  CASE WHEN event_id % 19 = 4 THEN '{"record_id":'||CAST(event_id AS STRING)||',"query":"cut'
       WHEN event_id % 19 = 5 THEN 'plain words'
       WHEN event_id % 19 = 6 THEN '{"record_id":"no number","query":"q","tools":"[]","answers":"[]"}'
       WHEN event_id % 19 = 7 THEN '{"record_id":'||CAST(event_id AS STRING)||',"query":"q","tools":"not json"}'
       ELSE '{"record_id":'||CAST(event_id AS STRING)||',"query":"Log '||event_type||'","tools":"[]","answers":"[]","source":"s'||CAST(event_id % 3 AS STRING)||'"}'
  END AS line
FROM @events
"""

# Whole outputs that should be arrays in the grammar's layout, or are not.
ARRAY_OUTPUTS = """
SELECT event_id AS record_id, event_type AS tool,
  CASE event_id % 10
    WHEN 0 THEN '['||chr(10)||'{"name":"'||event_type||'","arguments":{"a":[1,2],"s":"x, [y]"}},'||chr(10)||' 7]'
    WHEN 1 THEN '[{"name":"'||event_type||'"},{"name":"b"}]'
    WHEN 2 THEN '['||chr(10)||'1, 2]'
    WHEN 3 THEN '['||chr(10)||']'
    WHEN 4 THEN '['||chr(10)||'{"a":1,"b":[1,2,{"c":3,"d":"}],"}]}]'
    WHEN 5 THEN '['||chr(10)||'1]'||chr(10)
    WHEN 6 THEN '{"a":'||CAST(user_id AS STRING)||'}'
    WHEN 7 THEN '['||chr(10)||'1,'||chr(10)||'2,3]'
    WHEN 8 THEN '['||chr(10)||'{"a":1]'
    ELSE '['||chr(10)||'"a,b" ,'||chr(10)||'[1,2]]'
  END AS raw_response
FROM @events
"""

# Truth and outputs off the beaten track, one fault for each event_id % 13:
# truth that is no JSON, no list or no object; arguments as JSON text, a code
# fence, calls that are no objects, other key order, a missing output, ...
ODD_RECORDS = """
WITH b AS (
  SELECT event_id, event_id % 13 AS v, CAST(user_id AS STRING) AS uid, value, user_id,
    '{"user_id":'||CAST(user_id AS STRING)||',"props":'||props||'}' AS args, props
  FROM @events)
SELECT event_id AS record_id, 'Odd '||uid AS query, '[{"name":"do"},{"type":"function","function":{"name":"other"}},{"name":null}]' AS tools,
  CASE v WHEN 0 THEN 'not json' WHEN 1 THEN '{"name":"do","arguments":{}}' WHEN 2 THEN '[5]'
         WHEN 11 THEN '[{"name":"do","arguments":[1]}]'
         ELSE '[{"name":"do","arguments":'||args||'}]' END AS answers,
  CASE v
    WHEN 3 THEN '<tool_call>[{"name":"do","arguments":"'||replace(args, '"', chr(92)||'"')||'"}]</tool_call>'
    WHEN 4 THEN '<tool_call>```json'||chr(10)||'[{"name":"do","arguments":'||args||'}]'||chr(10)||'```</tool_call>'
    WHEN 5 THEN '<tool_call>[3]</tool_call>'
    WHEN 6 THEN '<tool_call>[{"name":"other","arguments":'||args||'}]</tool_call>'
    WHEN 7 THEN NULL
    WHEN 8 THEN '<tool_call>[{"name":"do","arguments":"no json"}]</tool_call>'
    WHEN 9 THEN '<tool_call>{"arguments":{"props":'||props||',"user_id":'||uid||'.0},"name":" do "}</tool_call>'
    WHEN 10 THEN '<tool_call>[{"name":"do","arguments":{"user_id":'||uid||',"props":[]}}]</tool_call>'
    WHEN 11 THEN '<tool_call>[{"name":"do","arguments":[2]}]</tool_call>'
    WHEN 12 THEN '<tool_call>[{"name":"do","arguments":{"user_id":true,"props":{"k":"x"}}}]</tool_call>'
    ELSE '<tool_call>[{"name":"do","arguments":'||args||'}]</tool_call>'
  END AS raw_response,
  value AS latency_ms, user_id AS generated_tokens
FROM b
"""

# Nested rows: messages as the string form of a list (backticks stand for
# apostrophes here), tools nested and flat; some lists or tools are no JSON.
NESTED_ROWS = """
SELECT event_id AS record_id,
  CASE WHEN event_id % 7 = 0 THEN 'not a list'
       ELSE replace('[{`from`: `human`, `value`: `Log '||event_type||' for user '||CAST(user_id AS STRING)||'`}, {`from`: `gpt`, `value`: `ok`}'
         ||CASE WHEN event_id % 7 = 1 THEN ', {`from`: `function_call`, `value`: `oops`}'
                WHEN event_id % 7 = 2 THEN ', {`role`: `user`, `content`: `again`}' ELSE '' END||']', '`', chr(39)) END AS conversations,
  CASE WHEN event_id % 11 = 0 THEN 'no json'
       WHEN event_id % 11 = 1 THEN NULL
       ELSE '[{"type":"function","function":{"name":"'||event_type||'"}},{"name":"lookup"},3]' END AS tools
FROM @events
"""

# Pairs of embeddings: each vector with its successor; some successors have
# one value more.
VECTOR_PAIRS = """
SELECT a.vec_id AS vec_id, a.embedding AS a,
  CASE WHEN a.vec_id % 13 = 5 THEN array_append(b.embedding, CAST(0 AS FLOAT)) ELSE b.embedding END AS b
FROM @embeddings a JOIN @embeddings b ON b.vec_id = a.vec_id + 1
"""

# Outputs with their event time, in order of arrival (0, 1, 2): the rows of
# arrival 2 are weeks late. Some outputs belong to no record.
ARRIVALS = """
SELECT CASE WHEN e.event_id % 89 = 3 THEN -1 - e.event_id ELSE e.event_id END AS record_id,
  r.raw_response, r.latency_ms, r.generated_tokens, e.ts AS event_time,
  CASE WHEN e.event_id % 101 = 7 AND extract(DAY FROM e.ts) <= 10 THEN 2
       WHEN extract(DAY FROM e.ts) <= 15 THEN 0 ELSE 1 END AS arrival
FROM @records r JOIN @events e ON e.event_id = r.record_id
"""

FIXTURES = {
    "arrivals": ARRIVALS,
    "json_lines": JSON_LINES,
    "array_outputs": ARRAY_OUTPUTS,
    "odd_records": ODD_RECORDS,
    "records": RECORDS,
    "turns": TURNS,
    "items": ITEMS,
    "inventory_calls": INVENTORY_CALLS,
    "loss_log": LOSS_LOG,
    "flat_rows": FLAT_ROWS,
    "nested_rows": NESTED_ROWS,
    "vector_pairs": VECTOR_PAIRS,
}

#: fixtures whose rows are wide texts: the table and the key it is dealt by first
DEALT = {"records": ("events", "event_id")}

_REF = re.compile(r"@([a-z_]+)")


def fixture_sql(name: str) -> str:
    """The fixture SQL over plain table names (the oracle's form)."""
    return _REF.sub(lambda m: m.group(1), FIXTURES[name])


def fixture_cte(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({fixture_sql(n)})" for n in names)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame. Input tables are bound to temp views named
    after the folder, so sessions with other views are not disturbed."""
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]

    def bind(m: re.Match) -> str:
        table = m.group(1)
        spread = DEALT.get(name) if DEALT.get(name, ("",))[0] == table else None
        view = f"cf_{table}_dealt_{tag}" if spread else f"cf_{table}_{tag}"
        if not spark.catalog.tableExists(view):
            rows = fixture(spark, sf_dir, table) if table in FIXTURES else read_table(spark, sf_dir, table)
            rows = dealt(rows, spread[1]) if spread else rows
            rows.createOrReplaceTempView(view)
        return view

    return spark.sql(_REF.sub(bind, FIXTURES[name]))
