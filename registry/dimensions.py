"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import derive, query, table
from turnwise.operators import dimensions, versions
from turnwise.session import scratch_path

# Known situations: pairs of brand and kind with an id; some are no longer valid.
KNOWN = """
SELECT CAST(min(p_partkey) + 1 AS BIGINT) AS id, lower(p_name) AS situation, lower(p_brand) AS scenario,
  p_type AS scenario_category, min(p_partkey) % 5 <> 0 AS is_valid
FROM {part} WHERE p_size <= 20 GROUP BY p_name, p_brand, p_type
"""
WANTED = "SELECT p_partkey, lower(p_name) AS situation, lower(p_brand) AS scenario, p_type AS scenario_category FROM {part}"
KEY = ["situation", "scenario", "scenario_category"]
KEY_TEXT = "situation || '|' || scenario || '|' || scenario_category || '|'"
CREATED = f"""
SELECT situation, scenario, scenario_category, (SELECT max(id) FROM ({KNOWN}))
  + row_number() OVER (ORDER BY md5({KEY_TEXT}), situation, scenario, scenario_category) AS id
FROM (SELECT DISTINCT situation, scenario, scenario_category FROM ({WANTED})
  EXCEPT SELECT situation, scenario, scenario_category FROM ({KNOWN}) WHERE is_valid)
"""


@query("allocate_ids", """
SELECT c_custkey, c_name, 1000 + row_number() OVER (ORDER BY md5(c_name || '|'), c_name) AS id FROM {customer}
""")
def _(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    return dimensions.allocate_ids(rows, "c_name", 1001)


@query("allocate_ids_lineitem", """
SELECT l_orderkey, CAST(count(*) AS BIGINT) AS lines, row_number() OVER (ORDER BY md5(CAST(l_orderkey AS VARCHAR) || '|'), l_orderkey) AS id
FROM {lineitem} GROUP BY l_orderkey
""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    return dimensions.allocate_ids(rows, "l_orderkey")


@query("get_or_create", f"""
SELECT w.p_partkey, situation, scenario, scenario_category, k.id FROM ({WANTED}) w JOIN (
  SELECT situation, scenario, scenario_category, id FROM ({KNOWN}) WHERE is_valid UNION ALL
  SELECT situation, scenario, scenario_category, id FROM ({CREATED})) k USING (situation, scenario, scenario_category)
""")
def _(spark, sf):
    ids, _ = dimensions.get_or_create(derive(spark, sf, KNOWN), derive(spark, sf, WANTED), KEY)
    return ids.select("p_partkey", *KEY, "id")


@query("get_or_create_dimension", f"""
SELECT id, situation, scenario, scenario_category, is_valid FROM ({KNOWN}) UNION ALL
SELECT id, situation, scenario, scenario_category, TRUE FROM ({CREATED})
""")
def _(spark, sf):
    _, after = dimensions.get_or_create(derive(spark, sf, KNOWN), derive(spark, sf, WANTED), KEY)
    return after.select("id", *KEY, "is_valid")


# A second run with the same rows finds everything and inserts nothing.
@query("get_or_create_again", f"""
SELECT (SELECT count(*) FROM ({KNOWN})) + (SELECT count(*) FROM ({CREATED})) AS rows
""")
def _(spark, sf):
    wanted = derive(spark, sf, WANTED)
    _, after = dimensions.get_or_create(derive(spark, sf, KNOWN), wanted, KEY)
    _, again = dimensions.get_or_create(after, wanted, KEY)
    return again.agg(F.count("*").alias("rows"))


# Two runs at once: the second one, with the even parts, commits while the first one works.
@query("get_or_create_at_once", f"""
SELECT id, situation, scenario, scenario_category, is_valid, CAST(3 AS BIGINT) AS versions FROM ({KNOWN}) UNION ALL
SELECT (SELECT max(id) FROM ({KNOWN})) + row_number() OVER (ORDER BY early DESC, md5({KEY_TEXT}), situation, scenario, scenario_category),
  situation, scenario, scenario_category, TRUE, 3 FROM ({CREATED})
JOIN (SELECT situation, scenario, scenario_category, max(p_partkey % 2 = 0) AS early FROM ({WANTED}) GROUP BY ALL)
USING (situation, scenario, scenario_category)
""")
def _(spark, sf):
    root = scratch_path(spark, "situations")
    versions.start_versions(derive(spark, sf, KNOWN), root)
    wanted = derive(spark, sf, WANTED)
    even = lambda dim: dimensions.get_or_create(dim, wanted.where("p_partkey % 2 = 0"), KEY)
    second = []

    def all_parts(dim):
        found = dimensions.get_or_create(dim, wanted, KEY)
        if not second:
            second.append(versions.update_version(spark, root, even))
        return found

    _, version = versions.update_version(spark, root, all_parts)
    return versions.read_version(spark, root).select(
        "id", *KEY, "is_valid", F.lit(version).cast("bigint").alias("versions")
    )


FACTS = """
SELECT l_orderkey * 10 + l_linenumber AS fact, min(l_partkey) + 1 AS situation_id, min(l_suppkey) AS prompt_id, 'p' AS project_name
FROM {lineitem} GROUP BY l_orderkey * 10 + l_linenumber
"""


@query("record_generated", f"""
SELECT fact, situation_id, prompt_id, 500 + row_number() OVER (ORDER BY md5(CAST(fact AS VARCHAR) || '|'), fact) AS id
FROM ({FACTS}) WHERE situation_id IN (SELECT id FROM ({KNOWN}))
  AND prompt_id IN (SELECT s_suppkey FROM {{supplier}} WHERE s_acctbal > 0)
""")
def _(spark, sf):
    prompts = table(spark, sf, "supplier").where("s_acctbal > 0")
    recorded = dimensions.record_generated(
        table(spark, sf, "supplier").select(F.lit(500).alias("id")),
        derive(spark, sf, KNOWN),
        prompts.select(F.col("s_suppkey").alias("id")),
        derive(spark, sf, FACTS),
        ["fact"],
    )
    return recorded.select("fact", "situation_id", "prompt_id", "id")


VALID = "SELECT c_custkey AS id, c_name, c_acctbal >= 0 AS is_valid FROM {customer}"


@query("invalidate", f"""
SELECT id, c_name, is_valid AND id NOT IN (3, 5, 8, 999999999) AS is_valid FROM ({VALID})
""")
def _(spark, sf):
    return dimensions.invalidate(derive(spark, sf, VALID), [3, 5, 8, 999999999])


# The list of ids is a table of its own.
@query("invalidate_table", f"""
SELECT id, c_name, is_valid AND id NOT IN (SELECT o_custkey FROM {{orders}} WHERE o_orderstatus = 'F') AS is_valid
FROM ({VALID})
""")
def _(spark, sf):
    gone = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return dimensions.invalidate(derive(spark, sf, VALID), gone)
