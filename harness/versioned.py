"""Queries over versioned targets: what is seen after failures, updates and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codonmill import fixed_values as fv
from codonmill.operators import quality
from codonmill.plans import links, ranged
from codonmill.plans.incremental import replace_keys
from codonmill.plans.refresh import Pipeline
from codonmill.plans.registry import spec
from codonmill.session import shared_folder
from codonmill.sources.versions import TableSet
from codonmill.streaming.landing import merge_new_files
from harness import shapes
from harness.landed import land_lines, orders

LINKS = "kegg_human_pathway_gene_lookup"
NAMES = "kegg_human_disease_name_lookup"


class Failure(RuntimeError):
    """Raised on purpose."""


def _pairs(spark: SparkSession, sf_dir: str, gene: str, where: str = "true") -> DataFrame:
    text = f"SELECT 'P' || CAST(o_orderkey AS STRING) AS PATHWAY_ID, {gene} AS GENE_ID FROM {{orders}} WHERE {where}"
    return shapes.frame(spark, sf_dir, text)


def s07_failed_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change that breaks off after writing leaves what readers see."""
    tables = TableSet(spark, shared_folder(spark))
    with tables.change() as change:
        change.write(_pairs(spark, sf_dir, "'G' || CAST(o_custkey AS STRING)"), LINKS)
    try:
        with tables.change() as change:
            change.write(_pairs(spark, sf_dir, "'wrong'"), LINKS)
            raise Failure
    except Failure:
        return tables.read(LINKS)


S7_FAILED = "SELECT 'P' || o_orderkey AS PATHWAY_ID, 'G' || o_custkey AS GENE_ID FROM orders"


def s07_committed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change replaces a table, the next adds to it; each earlier state stays readable."""
    tables = TableSet(spark, shared_folder(spark))
    for gene, overwrite in (("'first'", True), ("'second'", True), ("'added'", False)):
        with tables.change() as change:
            change.write(_pairs(spark, sf_dir, gene, "o_orderstatus = 'P'"), LINKS, overwrite)
    states = [tables.read(LINKS, n).withColumn("STATE", F.lit(n)) for n in (1, tables.latest())]
    return states[0].unionByName(states[1])


S7_COMMITTED = """
SELECT 'P' || o_orderkey AS PATHWAY_ID, GENE_ID, CAST(STATE AS INTEGER) AS STATE
FROM orders, (VALUES ('first', 1), ('second', 3), ('added', 3)) t(GENE_ID, STATE) WHERE o_orderstatus = 'P'"""


def _land_names(spark: SparkSession, sf_dir: str, folder: str, name: str, where: str) -> None:
    """Diseases of some orders with one or two names."""
    rows = orders(spark, sf_dir).where(where)
    key = F.concat(F.lit("H"), F.col("o_orderkey"))
    both = F.concat(F.lit(f"{name} "), "o_orderpriority", F.lit("; "), "o_orderstatus")
    land_lines(rows.select(key, both), f"{folder}/kegg_human_disease_{name}")


def _named(spark: SparkSession, base: str) -> DataFrame:
    return TableSet(spark, base).read(NAMES).select("DISEASE_ID", "DISEASE_NAME")


def _names_sql(*parts: tuple[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT 'DS' || o_orderkey AS DISEASE_ID, unnest(['{name} ' || o_orderpriority, o_orderstatus]) AS DISEASE_NAME "
        f"FROM orders WHERE {where}"
        for name, where in parts
    )


def t14_failed_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh in which one table fails leaves all tables as they were."""
    first, second, base = (shared_folder(spark) for _ in range(3))
    _land_names(spark, sf_dir, first, "one", "true")
    _land_names(spark, sf_dir, second, "two", "true")
    Pipeline(spark, "kegg", first, base, versioned=True).refresh(["disease"])
    try:
        # Nothing has landed for modules.
        Pipeline(spark, "kegg", second, base, versioned=True).refresh(["disease", "module"])
    except FileNotFoundError:
        pass
    return _named(spark, base)


def t14_changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refreshes of what has changed, after each of three files has landed."""
    landing, base = shared_folder(spark), shared_folder(spark)
    refresh = lambda: Pipeline(spark, "kegg", landing, base, versioned=True).refresh(["disease"], changed_only=True)
    _land_names(spark, sf_dir, landing, "one", "o_orderkey % 3 = 0")
    refresh()
    _land_names(spark, sf_dir, landing, "two", "o_orderkey % 3 = 1")
    refresh()
    # The same again changes nothing.
    assert not refresh()
    _land_names(spark, sf_dir, landing, "three", "o_orderkey % 3 = 2")
    refresh()
    return _named(spark, base)


T14_CHANGED = _names_sql(("one", "o_orderkey % 3 = 0"), ("two", "o_orderkey % 3 = 1"), ("three", "o_orderkey % 3 = 2"))


def t15_streamed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that land again in a later run show their later names only, or none."""
    landing, base, checkpoint = (shared_folder(spark) for _ in range(3))
    run = lambda: merge_new_files(spark, landing, "disease", base, checkpoint, 8).awaitTermination()
    _land_names(spark, sf_dir, landing, "one", "o_orderkey % 3 < 2")
    run()
    _land_names(spark, sf_dir, landing, "two", "o_orderkey % 3 > 0 AND o_orderkey % 5 > 0")
    emptied = orders(spark, sf_dir).where("o_orderkey % 15 = 10")
    emptied.select(F.concat(F.lit("H"), F.col("o_orderkey")).alias("value")).write.text(f"{landing}/kegg_human_disease_three")
    run()
    return _named(spark, base)


T15_MERGED = _names_sql(
    ("one", "o_orderkey % 3 < 2 AND NOT (o_orderkey % 3 > 0 AND o_orderkey % 5 > 0) AND o_orderkey % 15 <> 10"),
    ("two", "o_orderkey % 3 > 0 AND o_orderkey % 5 > 0"),
)


def t15_ranged_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some keys come with other rows, some as they are, some for the first time."""
    tables = TableSet(spark, shared_folder(spark))
    stored = _pairs(spark, sf_dir, "'G' || CAST(o_custkey AS STRING)")
    with tables.change() as change:
        ranged.save_ranged(change, stored.unionByName(stored), LINKS, "PATHWAY_ID", 16)
    same = stored.unionByName(stored).where("PATHWAY_ID < 'P2'")
    other = _pairs(spark, sf_dir, "'new'", "o_orderkey % 100 = 7")
    fresh = shapes.frame(spark, sf_dir, "SELECT 'C' || CAST(c_custkey AS STRING) AS PATHWAY_ID, c_name AS GENE_ID FROM {customer}")
    with tables.change() as change:
        ranged.update_ranged(change, same.where("NOT PATHWAY_ID LIKE '%07'").unionByName(other).unionByName(fresh), LINKS, "PATHWAY_ID")
    return tables.read(LINKS)


T15_RANGED = """
SELECT 'P' || o_orderkey AS PATHWAY_ID, unnest(['G' || o_custkey, 'G' || o_custkey]) AS GENE_ID
FROM orders WHERE o_orderkey % 100 <> 7
UNION ALL SELECT 'P' || o_orderkey, 'new' FROM orders WHERE o_orderkey % 100 = 7
UNION ALL SELECT 'C' || c_custkey, c_name FROM customer"""


def t14_load_from_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session reads and stages raw rows, another makes and loads tables of them."""
    landing, stage, target = (shared_folder(spark) for _ in range(3))
    land_lines(shapes.raw(spark, sf_dir, "disease"), f"{landing}/kegg_human_disease")
    first = Pipeline(spark, "kegg", landing, stage=stage)
    first.extract("disease")
    first.save("disease")
    return spark.read.parquet(Pipeline(spark, "kegg", shared_folder(spark), target, stage=stage).load(NAMES))


def _table(spark: SparkSession, sf_dir: str, source: str, table: str, output: str) -> DataFrame:
    return spec(source, table).table(shapes.raw(spark, sf_dir, table), output)


def j08_resolved_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.resolved_symbols(
        links.ranked_symbols(
            _table(spark, sf_dir, "ncbi", "gene_info", "gene_info"),
            _table(spark, sf_dir, "ncbi", "gene_summary", "gene_summary"),
            _table(spark, sf_dir, "kegg", "gene", "gene_symbol_lookup"),
            _table(spark, sf_dir, "ncbi", "gene_info", "gene_info_symbol_lookup"),
            _table(spark, sf_dir, "ncbi", "gene_summary", "gene_summary_symbol_lookup"),
        )
    )


def j08_variant_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    variant = _table(spark, sf_dir, "kegg", "variant", "variant")
    return links.variant_gene(variant, j08_resolved_symbols(spark, sf_dir))


def resolved_sql(info: str, summary: str, gene: str, info_symbols: str, summary_symbols: str) -> str:
    return f"""
SELECT GENE_SYMBOL, CASE WHEN count(*) FILTER (RANK = best) = 1 THEN min(GENE_ID) FILTER (RANK = best) END AS GENE_ID,
  CAST(min(RANK) AS INTEGER) AS RANK, count(*) - 1 AS N_RIVALS
FROM (
  SELECT *, min(RANK) OVER (PARTITION BY GENE_SYMBOL) AS best
  FROM (
    SELECT GENE_SYMBOL, GENE_ID, min(RANK) AS RANK
    FROM (
      SELECT GENE_SYMBOL, GENE_ID, CASE NOMENCLATURE_STATUS WHEN 1 THEN 1 ELSE 2 END AS RANK FROM ({info})
      UNION ALL SELECT GENE_SYMBOL, GENE_ID, 2 FROM ({summary})
      UNION ALL SELECT GENE_SYMBOL, GENE_ID, CASE GENE_ALIAS_NO WHEN 1 THEN 2 ELSE 3 END FROM ({gene})
      UNION ALL SELECT GENE_SYMBOL, GENE_ID, 3 FROM ({info_symbols})
      UNION ALL SELECT GENE_SYMBOL, GENE_ID, 4 FROM ({summary_symbols}))
    WHERE GENE_ID IS NOT NULL AND GENE_SYMBOL NOT IN ('', 'None') GROUP BY GENE_SYMBOL, GENE_ID))
GROUP BY GENE_SYMBOL"""


def j01_maintained_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged profile of older inputs, brought up to date from what has changed in them."""
    after = {
        "gene_info": _table(spark, sf_dir, "ncbi", "gene_info", "gene_info"),
        "gene_summary": _table(spark, sf_dir, "ncbi", "gene_summary", "gene_summary"),
        "gene": _table(spark, sf_dir, "kegg", "gene", "gene"),
        "ncbi_gene_lookup": _table(spark, sf_dir, "kegg", "ncbi_gene", "ncbi_gene_lookup"),
    }
    share = F.pmod(F.xxhash64("GENE_ID"), F.lit(10))
    old = lambda column, at: F.when(share == at, F.concat(column, F.lit("9"))).otherwise(F.col(column))
    removed = after["gene"].where(share == 3).withColumn("GENE_ID", F.concat("GENE_ID", F.lit("99")))
    before = {
        "gene_info": after["gene_info"].where(share != 0).withColumn("GENE_TYPE", old("GENE_TYPE", 1)),
        "gene_summary": after["gene_summary"].where(share != 2),
        "gene": after["gene"].where(share != 4).unionByName(removed),
        "ncbi_gene_lookup": after["ncbi_gene_lookup"].where(share != 6).withColumn("NCBI_GENE_ID", old("NCBI_GENE_ID", 5)),
    }
    changed = {
        "gene_info": after["gene_info"].where(share < 2).select("GENE_ID"),
        "gene_summary": after["gene_summary"].where(share == 2).select("GENE_ID"),
        "gene": after["gene"].where(share == 4).unionByName(removed).select("GENE_ID"),
        "ncbi_gene_lookup": after["ncbi_gene_lookup"].where(share.isin(5, 6)).select("GENE_ID"),
    }
    ids, profiles = links.changed_profiles(before, after, changed)
    return replace_keys(links.gene_merged(**before), profiles, "GENE_ID", ids)


def v04_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of diseases, some of which neither the stored table nor the same update has."""
    tables = TableSet(spark, shared_folder(spark))
    one = lambda n: shapes.frame(
        spark,
        sf_dir,
        f"SELECT 'DS' || CAST(o_orderkey AS STRING) AS DISEASE_ID, CAST(1 AS INT) AS DISEASE_NAME_COUNT "
        f"FROM {{orders}} WHERE o_orderkey % 3 = {n}",
    )
    with tables.change() as change:
        ranged.save_ranged(change, one(0), "kegg_human_disease", "DISEASE_ID", 16)
    names = shapes.frame(spark, sf_dir, "SELECT 'DS' || CAST(l_orderkey AS STRING) AS DISEASE_ID FROM {lineitem}")
    return ranged.increment_violations(tables.change(), names, NAMES, one(1).select("DISEASE_ID"))


V4_INCREMENT = """
SELECT 'kegg_human_disease_name_lookup' AS TABLE_NAME, 'reference' AS RULE, 'DISEASE_ID' AS COLUMN_NAME,
  'DS' || l_orderkey AS KEY_VALUE, count(*) AS N_ROWS
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 < 2) GROUP BY l_orderkey"""


_LOOSE = """SELECT CASE WHEN event_type <> 'error' THEN 'V' || CAST(user_id AS STRING) END AS VARIANT_ID,
  'name of ' || props || ' ' || event_type AS VARIANT_NAME,
  CASE event_type WHEN 'view' THEN 'x' || CAST(event_id AS STRING) ELSE CAST(event_id AS STRING) END AS VARIANT_VERSION,
  'SYM' || repeat(event_type, 4) AS GENE_SYMBOL FROM {events}"""


def v03_v05_v06_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a rule, with what they break."""
    loose = shapes.frame(spark, sf_dir, _LOOSE)
    _, rejected, _ = quality.split_rows(loose, "kegg_human_variant", shared_folder(spark))
    return rejected.withColumn("BROKEN", F.array_join("BROKEN", ", "))


def v03_v05_v06_accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that keep all rules, with their final types."""
    loose = shapes.frame(spark, sf_dir, _LOOSE)
    return quality.split_rows(loose, "kegg_human_variant", shared_folder(spark))[0]


def _broken_sql() -> str:
    rules = []
    for name, kind, width, required in fv.TABLES["kegg_human_variant"]:
        rules += [f"CASE WHEN {name} IS NULL THEN 'not_null {name}' END"] if required else []
        rules += [f"CASE WHEN length({name}) > {width} THEN 'width {name}' END"] if width else []
        if kind != "string":
            rules.append(f"CASE WHEN {name} IS NOT NULL AND try_cast({name} AS INTEGER) IS NULL THEN 'type {name}' END")
    loose = shapes.duckdb_text(_LOOSE)
    return f"SELECT *, concat_ws(', ', {', '.join(rules)}) AS BROKEN FROM ({loose})"


QUERIES = {
    "s07_failed_change": s07_failed_change,
    "s07_committed_changes": s07_committed_changes,
    "t14_failed_refresh": t14_failed_refresh,
    "t14_changed_files": t14_changed_files,
    "t14_load_from_stage": t14_load_from_stage,
    "t15_streamed_merge": t15_streamed_merge,
    "t15_ranged_update": t15_ranged_update,
    "j01_maintained_profile": j01_maintained_profile,
    "j08_resolved_symbols": j08_resolved_symbols,
    "j08_variant_gene": j08_variant_gene,
    "v04_increment": v04_increment,
    "v03_v05_v06_rejected_rows": v03_v05_v06_rejected_rows,
    "v03_v05_v06_accepted_rows": v03_v05_v06_accepted_rows,
}


def oracles(jobs: dict[str, str]) -> dict[str, str]:
    """SQL of these queries, given that of the table jobs by their queries' names."""
    resolved = resolved_sql(
        *[
            jobs[name]
            for name in (
                "t07_gene_info",
                "t10_gene_summary",
                "t02_gene_symbol_lookup",
                "t07_gene_info_symbol_lookup",
                "t10_gene_summary_symbol_lookup",
            )
        ]
    )
    variant = f"""
SELECT VARIANT_ID, VARIANT_VERSION, GENE_SYMBOL, r.GENE_ID, r.RANK, r.N_RIVALS
FROM ({jobs["t04_variant"]}) LEFT JOIN ({resolved}) r USING (GENE_SYMBOL)"""
    return {
        "s07_failed_change": S7_FAILED,
        "s07_committed_changes": S7_COMMITTED,
        "t14_failed_refresh": _names_sql(("one", "true")),
        "t14_changed_files": T14_CHANGED,
        "t14_load_from_stage": jobs["t03_disease_name_lookup"],
        "t15_streamed_merge": T15_MERGED,
        "t15_ranged_update": T15_RANGED,
        "j01_maintained_profile": jobs["t12_j01_gene_merged"],
        "v04_increment": V4_INCREMENT,
        "j08_resolved_symbols": resolved,
        "j08_variant_gene": variant,
        "v03_v05_v06_rejected_rows": f"{_broken_sql()} WHERE BROKEN <> ''",
        "v03_v05_v06_accepted_rows": f"""
SELECT VARIANT_ID, VARIANT_NAME, CAST(VARIANT_VERSION AS INTEGER) AS VARIANT_VERSION, GENE_SYMBOL
FROM ({_broken_sql()}) WHERE BROKEN = ''""",
    }
