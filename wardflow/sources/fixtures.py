"""The ``encounters`` test table: a pure per-row function of ``lineitem``.

The encounter file of the source application is not shipped, so its 50-column
schema is refilled with synthetic values. Every value is a function of one
``lineitem`` row (md5 bytes of a four-part key), so Spark and DuckDB build
identical rows and the table grows with ``lineitem``.

One rule table drives two renderings: Spark ``Column`` expressions for the
operators, and a DuckDB SQL text for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.schema import MEDICATION_COLUMNS, RAW_COLUMNS

KEY_PARTS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
N_HASHES = 3          # 3 md5 digests x 16 bytes = 48 bytes b0..b47
PATIENTS = 5000
ROWS_A_TASK = 125_000  # a table of more rows than that for each core is dealt over more tasks; MLlib's trees keep 1.2 kB a row of each

# ---------------------------------------------------------------------------
# Fixed values of the fixture (see FIXTURES.md). Bands read left to right:
# (value, upper bound exclusive); the last value takes the rest.
# ---------------------------------------------------------------------------
DIAG_CODES = ["250", "250.83", "428", "414", "401", "585", "486", "493", "272",
              "V45", "V57", "E909", "E878", "5", "54", "9", "38", "459", "459.81",
              "785", "786", "715", "?", "174"]

MED_BANDS = [("No", 200), ("Steady", 230), ("Up", 243)], "Down"

RULES: dict[str, tuple] = {
    "race": ("bands", 0, [("Caucasian", 190), ("AfricanAmerican", 235), ("?", 243),
                          ("Hispanic", 248), ("Other", 253)], "Asian"),
    "gender": ("bands", 1, [("Female", 137), ("Male", 255)], "Unknown/Invalid"),
    "age": ("age", 2),
    "weight": ("bands", 3, [("?", 248)], "[75-100)"),
    "admission_type_id": ("mod", 4, 1, 8),
    "discharge_disposition_id": ("mod", 5, 1, 30),
    "admission_source_id": ("mod", 6, 1, 26),
    "time_in_hospital": ("mod", 7, 1, 14),
    "payer_code": ("bands", 8, [("?", 102), ("MC", 200)], "HM"),
    "medical_specialty": ("bands", 9, [("?", 126), ("InternalMedicine", 200)], "Cardiology"),
    "num_lab_procedures": ("mod", 10, 1, 120),
    "num_procedures": ("mod", 11, 0, 7),
    "num_medications": ("gated", 12, 250, ("mod", 1, 60), "?"),
    "number_outpatient": ("gated", 13, 210, "0", ("mod", 0, 5)),
    "number_emergency": ("gated", 14, 225, "0", ("mod", 0, 5)),
    "number_inpatient": ("gated", 15, 170, "0", ("mod", 0, 6)),
    "diag_1": ("pick", 16, DIAG_CODES),
    "diag_2": ("pick", 17, DIAG_CODES),
    "diag_3": ("pick", 18, DIAG_CODES),
    "number_diagnoses": ("mod", 19, 1, 16),
    "max_glu_serum": ("bands", 20, [("None", 242), ("Norm", 248), (">200", 252)], ">300"),
    "A1Cresult": ("bands", 21, [("None", 213), (">8", 234), ("Norm", 246)], ">7"),
    **{m: ("bands", 22 + i, MED_BANDS[0], MED_BANDS[1]) for i, m in enumerate(MEDICATION_COLUMNS)},
    "change": ("bands", 45, [("No", 137)], "Ch"),
    "diabetesMed": ("bands", 46, [("Yes", 197)], "No"),
    # s = b47 + 20 * number_inpatient
    "readmitted": ("target", 47, 20, [("NO", 145), (">30", 225)], "<30"),
}


# ---------------------------------------------------------------------------
# Spark rendering
# ---------------------------------------------------------------------------

def _spark_word(h: int, w: int) -> Column:
    """32-bit word ``w`` (0..3) of digest ``h`` from its 8 hex characters."""
    return F.conv(F.substring(F.col(f"_h{h}"), 8 * w + 1, 8), 16, 10).cast("bigint")


def _spark_byte(n: int) -> Column:
    """Byte n: hex characters 2*(n mod 16)+1..+2 of digest n div 16, taken from its word."""
    shift = 8 * (3 - n % 4)
    return F.shiftright(F.col(f"_w{n // 4}"), shift).bitwiseAND(255).cast("int")


def _spark_bands(b: Column, bands, rest) -> Column:
    expr = None
    for value, upper in bands:
        expr = F.when(b < upper, F.lit(value)) if expr is None else expr.when(b < upper, F.lit(value))
    return expr.otherwise(F.lit(rest))


def _text(b: int, spec) -> str:
    if isinstance(spec, str):
        return spec
    _, offset, mod = spec
    return str(offset + b % mod)


def _value(rule: tuple, b: int) -> str:
    """The value that a rule of one byte gives byte ``b``."""
    kind = rule[0]
    if kind == "bands":
        return next((value for value, upper in rule[2] if b < upper), rule[3])
    if kind == "mod":
        return str(rule[2] + b % rule[3])
    if kind == "age":
        return f"[{b % 10 * 10}-{b % 10 * 10 + 10})"
    if kind == "gated":
        return _text(b, rule[3] if b < rule[2] else rule[4])
    if kind == "pick":
        return rule[2][b % len(rule[2])]
    raise ValueError(kind)


def _spark_rule(name: str, rule: tuple) -> Column:
    """The column of a rule: its byte's entry in the constant array of the rule's 256 values (the optimizer folds the split)."""
    b = F.col(f"_b{rule[1]}")
    if rule[0] == "target":
        s = b + F.lit(rule[2]) * F.col("number_inpatient").cast("int")
        return _spark_bands(s, rule[3], rule[4])
    return F.get(F.split(F.lit("\t".join(_value(rule, i) for i in range(256))), "\t"), b)


def encounters_from_lineitem(lineitem: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Build the 50-column all-string encounter table from ``lineitem``.

    Only the four key columns are read. ``parallelism`` spreads the keys by a
    hash of all four parts first (unique together, so no hot partition, and no
    sort as a round-robin spread would need), for a file of a single row group;
    without it the scan's own splits are kept (no shuffle).
    """
    keys = lineitem.select(*KEY_PARTS)
    if parallelism:
        keys = keys.repartition(parallelism, *KEY_PARTS)
    k = F.concat_ws("|", *[F.col(c).cast("string") for c in KEY_PARTS])
    hashed = keys.select(
        k.alias("_k"),
        F.col("l_orderkey"),
        *[F.md5(F.concat(k, F.lit(f"#{i}"))).alias(f"_h{i}") for i in range(N_HASHES)],
    )
    words = hashed.select("_k", "l_orderkey",
                          *[_spark_word(h, w).alias(f"_w{4 * h + w}") for h in range(N_HASHES) for w in range(4)])
    with_bytes = words.select("_k", "l_orderkey", *[_spark_byte(n).alias(f"_b{n}") for n in range(16 * N_HASHES)])
    first = [F.col("_k").alias("encounter_id"),
             (F.col("l_orderkey") % PATIENTS).cast("string").alias("patient_nbr")]
    # number_inpatient is needed by the target rule; build it in the same projection.
    cols = first + [_spark_rule(c, RULES[c]).alias(c) for c in RAW_COLUMNS[2:] if c != "readmitted"]
    staged = with_bytes.select(*cols, F.col("_b47"))
    return staged.select(*[F.col(f"`{c}`") for c in RAW_COLUMNS[:-1]],
                         _spark_rule("readmitted", RULES["readmitted"]).alias("readmitted"))


def load_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    rows = lineitem.count()  # read off the files' footers
    return encounters_from_lineitem(lineitem, max(int(spark.sparkContext.defaultParallelism), -(-rows // ROWS_A_TASK)))


# ---------------------------------------------------------------------------
# DuckDB rendering (oracle side)
# ---------------------------------------------------------------------------

def _sql_lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _sql_bands(b: str, bands, rest) -> str:
    whens = " ".join(f"WHEN {b} < {u} THEN {_sql_lit(v)}" for v, u in bands)
    return f"CASE {whens} ELSE {_sql_lit(rest)} END"


def _sql_text(b: str, spec) -> str:
    if isinstance(spec, str):
        return _sql_lit(spec)
    _, offset, mod = spec
    return f"CAST({offset} + {b} % {mod} AS VARCHAR)"


def _sql_rule(rule: tuple) -> str:
    kind, n = rule[0], rule[1]
    b = f"_b{n}"
    if kind == "bands":
        return _sql_bands(b, rule[2], rule[3])
    if kind == "mod":
        return f"CAST({rule[2]} + {b} % {rule[3]} AS VARCHAR)"
    if kind == "age":
        lo = f"(({b} % 10) * 10)"
        return f"'[' || CAST({lo} AS VARCHAR) || '-' || CAST({lo} + 10 AS VARCHAR) || ')'"
    if kind == "gated":
        return f"CASE WHEN {b} < {rule[2]} THEN {_sql_text(b, rule[3])} ELSE {_sql_text(b, rule[4])} END"
    if kind == "pick":
        codes = ", ".join(_sql_lit(c) for c in rule[2])
        return f"([{codes}])[{b} % {len(rule[2])} + 1]"
    if kind == "target":
        return _sql_bands(f"({b} + {rule[2]} * CAST(number_inpatient AS INTEGER))", rule[3], rule[4])
    raise ValueError(kind)


def encounters_sql_ctes() -> str:
    """CTE list (without WITH) ending in a view named ``encounters``."""
    k = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in KEY_PARTS) + ")"
    hashes = ", ".join(f"md5(_k || '#{i}') AS _h{i}" for i in range(N_HASHES))
    bytes_ = ", ".join(
        f"CAST(('0x' || substr(_h{n // 16}, {2 * (n % 16) + 1}, 2)) AS INTEGER) AS _b{n}"
        for n in range(16 * N_HASHES))
    cols = [f"_k AS encounter_id", f"CAST(l_orderkey % {PATIENTS} AS VARCHAR) AS patient_nbr"]
    cols += [f"{_sql_rule(RULES[c])} AS \"{c}\"" for c in RAW_COLUMNS[2:] if c != "readmitted"]
    final = ", ".join(f'"{c}"' for c in RAW_COLUMNS[:-1])
    return (
        f"_fx_keys AS (SELECT {k} AS _k, l_orderkey FROM lineitem), "
        f"_fx_hash AS (SELECT _k, l_orderkey, {hashes} FROM _fx_keys), "
        f"_fx_bytes AS (SELECT _k, l_orderkey, {bytes_} FROM _fx_hash), "
        f"_fx_cols AS (SELECT {', '.join(cols)}, _b47 FROM _fx_bytes), "
        f"encounters AS (SELECT {final}, {_sql_rule(RULES['readmitted'])} AS readmitted FROM _fx_cols)"
    )
