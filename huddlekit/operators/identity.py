"""Player identity resolution across id systems.

The bridge is inverted into one index of (id system, key): every id column is
a system, and so is the normalized name with the position. A key that stands
for more than one bridge row is refused (NULL), never guessed. A fact names
the system and the key it brings, so facts of any mix of sources are read once
and joined once; those without a key are spread over the reducers.

Every input row is kept; unresolved rows carry a NULL id. The index is a
dimension (about 10^4 rows per system upstream) that AQE broadcasts once its
measured size is under the broadcast threshold, and the plan stays a shuffle
join when it is not.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit.functions.exprs import to_long
from huddlekit.operators.skew import left_lookup

# Generational suffixes dropped from the end of a merge name.
NAME_SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")


def normalize_merge_name(x) -> Column:
    """lower; drop '.', apostrophes (straight and curly); collapse whitespace;
    drop trailing suffix tokens while more than one token remains; a NULL or
    non-string becomes ''."""
    c = F.col(x) if isinstance(x, str) else x
    s = F.lower(c.cast("string"))
    s = F.regexp_replace(s, "[.'’]", "")
    s = F.regexp_replace(s, r"(?U)\s+", " ")
    s = F.regexp_replace(s, r"^ | $", "")
    suffix = "|".join(NAME_SUFFIXES)
    # a suffix must follow a space, so the first token always survives
    s = F.regexp_replace(s, rf"( ({suffix}))+$", "")
    return F.coalesce(s, F.lit(""))


def name_key(name, position) -> Column:
    """Key of the ``name`` system: normalized name and position; NULL for a
    blank name."""
    n = F.nullif(normalize_merge_name(name), F.lit(""))
    p = F.col(position) if isinstance(position, str) else position
    return F.concat(n, F.lit("\u0001"), F.coalesce(p.cast("string"), F.lit("")))


def id_key(x) -> Column:
    """Key of an integer id that may arrive as a number or as text."""
    return to_long(x).cast("string")


def bridge_index(bridge: DataFrame, systems: dict[str, Column], target: str = "gsis_id") -> DataFrame:
    """``system, key, rid, n_rows``: one row per key of each system, from one
    pass over the bridge. ``rid`` is NULL for a refused key: one that more
    than one bridge row with a target id holds (rows are counted, not ids:
    two rows of one id are refused too)."""
    keys = F.array(*[F.struct(F.lit(s).alias("system"), k.cast("string").alias("key")) for s, k in systems.items()])
    return (bridge.where(F.col(target).isNotNull())
            .select(F.col(target).alias("_rid"), F.explode(keys).alias("_e")).where(F.col("_e.key").isNotNull())
            .groupBy(F.col("_e.system").alias("system"), F.col("_e.key").alias("key"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.any_value("_rid").alias("_rid"))
            .select("system", "key", F.when(F.col("n_rows") == 1, F.col("_rid")).alias("rid"), "n_rows"))


def index_tally(index: DataFrame) -> DataFrame:
    """``system, keys, refused``: keys of each system and how many of them
    are refused."""
    return index.groupBy("system").agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n_rows") > 1).alias("refused"))


def look_up(facts: DataFrame, index: DataFrame, system: Column, key: Column, out: str,
            outcome: str | None = None) -> DataFrame:
    """``facts`` with ``out``, the id its key stands for, and, if named,
    ``outcome``: resolved, refused, unknown or no key."""
    right = index.select(F.concat_ws("\u0002", "system", "key").alias("_key"), F.col("rid").alias("_rid"),
                         F.col("n_rows").alias("_n"))
    asked = F.concat(system, F.lit("\u0002"), key)
    # one key column: the NULLs of a fact without system or key are spread alike
    found = left_lookup(facts.withColumn("_asked", asked), right, F.col("_asked"), "_key")
    said = (F.when(F.col("_asked").isNull(), "no key").when(F.col("_n").isNull(), "unknown")
            .when(F.col("_n") > 1, "refused").otherwise("resolved"))
    named = [c for c in facts.columns if c not in (out, outcome)]
    cols = [F.col("_rid").alias(out) if c == out else F.col(f"`{c}`") for c in facts.columns if c != outcome]
    if len(named) == len([c for c in facts.columns if c != outcome]):
        cols.append(F.col("_rid").alias(out))
    if outcome:
        cols.append(said.alias(outcome))
    return found.select(*cols)


def resolve_by_id(facts: DataFrame, bridge: DataFrame, *, fact_id: str = "source_player_id",
                  bridge_id: str = "mfl_id", target: str = "gsis_id",
                  out: str = "gsis_id_resolved") -> DataFrame:
    index = bridge_index(bridge, {"id": id_key(bridge_id)}, target)
    return look_up(facts, index, F.lit("id"), id_key(fact_id), out)


def resolve_by_name(facts: DataFrame, bridge: DataFrame, *, name: str = "player_name",
                    position: str = "position", bridge_name: str = "merge_name",
                    bridge_position: str = "position", target: str = "gsis_id",
                    out: str = "gsis_id_resolved") -> DataFrame:
    index = bridge_index(bridge, {"name": name_key(bridge_name, bridge_position)}, target)
    return look_up(facts, index, F.lit("name"), name_key(name, position), out)


def resolve_ids(adp: DataFrame, bridge: DataFrame, *, by_id_source: str = "mfl",
                by_name_source: str = "ffc", out: str = "gsis_id", outcome: str | None = None) -> DataFrame:
    """Dispatcher: rows of ``by_id_source`` resolve by exact id, rows of
    ``by_name_source`` by name, other sources stay unresolved; every row is
    kept and the column set is unchanged (``out`` is overwritten). The rows
    are read once and joined once, whichever way they resolve."""
    index = bridge_index(bridge, {"id": id_key("mfl_id"), "name": name_key("merge_name", "position")})
    is_id, is_name = F.col("source") == by_id_source, F.col("source") == by_name_source
    return look_up(adp, index, F.when(is_id, "id").when(is_name, "name"),
                   F.when(is_id, id_key("source_player_id")).when(is_name, name_key("player_name", "position")),
                   out, outcome)


def resolve_any(facts: DataFrame, bridge: DataFrame, id_columns: list[str], *, system: str = "id_system",
                key: str = "id", target: str = "gsis_id", out: str = "gsis_id",
                outcome: str | None = None) -> DataFrame:
    """Facts that name one of the bridge's id columns in ``system`` and bring
    its value as text in ``key``. Integer ids are compared as numbers, so
    ``0123`` and ``123.0`` mean 123; others as they are, trimmed."""
    types = {f.name: f.dataType for f in bridge.schema.fields}
    numeric = [c for c in id_columns if isinstance(types[c], (T.LongType, T.IntegerType))]
    index = bridge_index(bridge, {c: F.col(c) if c in numeric else F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
                                  for c in id_columns}, target)
    asked = F.when(F.col(system).isin(*numeric), id_key(key)) if numeric else F.lit(None).cast("string")
    words = F.when(F.col(system).isin(*[c for c in id_columns if c not in numeric]),
                   F.nullif(F.trim(F.col(key)), F.lit("")))
    return look_up(facts, index, F.col(system), F.coalesce(asked, words), out, outcome)


def resolution_rate(df: DataFrame, id_col: str = "gsis_id") -> Column:
    """Share of rows with a resolved id; 0.0 for no rows."""
    return F.coalesce(F.avg(F.col(id_col).isNotNull().cast("double")), F.lit(0.0))
