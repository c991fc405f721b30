"""Decode admission / discharge / source ids with the code maps (joins the planner sizes by its byte threshold)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.schema import CODE_MAP_COLUMNS, q

MOST_LITERALS = 500


def unique_codes(maps: DataFrame) -> DataFrame:
    """One description per (map, code) so a join never multiplies rows."""
    return maps.groupBy("map_name", "code").agg(F.min("description").alias("description"))


def decode_ids(df: DataFrame, maps: DataFrame, cols: Sequence[str] = tuple(CODE_MAP_COLUMNS)) -> DataFrame:
    """Add ``<col>_description`` for each id column; unmatched ids keep a NULL description.

    Maps of at most ``MOST_LITERALS`` codes in all (the shipped file has 64) become one constant
    map for each column, looked up in the projection of the scan: no join. Larger ones are
    joined; whether they are broadcast is then the planner's choice, by their size in
    bytes (``spark.sql.autoBroadcastJoinThreshold``), and AQE splits hot ids.
    """
    m = unique_codes(maps.where(F.col("map_name").isin(*cols)))
    known = m.limit(MOST_LITERALS + 1).collect()
    if len(known) <= MOST_LITERALS:
        of = {c: {r["code"]: r["description"] for r in known if r["map_name"] == c and r["code"] is not None} for c in cols}
        looked = {c: F.try_element_at(F.from_json(F.lit(json.dumps(of[c])), "map<string,string>"), F.col(q(c)).cast("string")) for c in cols}
        return df.withColumns({f"{c}_description": expr for c, expr in looked.items()})
    out = df
    for c in cols:
        side = m.where(F.col("map_name") == F.lit(c)).select(
            F.col("code").alias(f"__code_{c}"), F.col("description").alias(f"{c}_description"))
        out = out.join(side, F.col(q(c)) == F.col(f"__code_{c}"), "left").drop(f"__code_{c}")
    return out


def code_usage(df: DataFrame, maps: DataFrame, cols: Sequence[str] = tuple(CODE_MAP_COLUMNS)) -> DataFrame:
    """Code map with the number of encounters per code, plus codes seen but not mapped.

    ``(map_name, code, description, n_encounters)``: counts come from one
    Expand + partial aggregate over the id columns; the map side is small.
    """
    counts = (df.select(*[F.col(q(c)).cast("string").alias(c) for c in cols])
              .unpivot([], list(cols), "map_name", "code")
              .where(F.col("code").isNotNull())
              .groupBy("map_name", "code").agg(F.count(F.lit(1)).alias("n_encounters")))
    m = unique_codes(maps.where(F.col("map_name").isin(*cols)))
    joined = m.join(counts, ["map_name", "code"], "full_outer")
    return joined.select("map_name", "code", "description",
                         F.coalesce(F.col("n_encounters"), F.lit(0)).cast("bigint").alias("n_encounters"))
