"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each twin starts from the same ``encounters`` view (``fixtures.encounters_sql_ctes``)
and restates the query in plain SQL, independently of the Spark code path.
Parity rules: DuckDB ``CAST(2.9 AS INT)`` rounds, so integer means use
``trunc``; ``SUM`` of integers is HUGEINT, so counts are cast to BIGINT;
division by zero is guarded with ``NULLIF``; decimal literals are cast to DOUBLE.
"""

from __future__ import annotations

import csv
import io

from wardflow.schema import (CATEGORICAL_COLUMNS, CHANGE_VALUES, DIAG_CATEGORIES, DIAG_CATEGORY_OTHER,
                             DIAGNOSIS_COLUMNS, DROP_COLUMNS, KEY, MAJOR_DISEASE_GROUPS, MEDICATION_COLUMNS,
                             MISSING_TOKEN, NUMERIC_COLUMNS, PER_DAY_RATIOS, RAW_COLUMNS, RECORD_FIELDS,
                             STAY_COLUMN)
from wardflow.sources.files import code_map_text
from wardflow.sources.fixtures import encounters_sql_ctes


def i(c: str) -> str:
    return '"' + c.replace('"', '""') + '"'


def lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def cols(names) -> str:
    return ", ".join(i(c) for c in names)


TOK = lit(MISSING_TOKEN)
DROP_NOT_KEY = [c for c in DROP_COLUMNS if c != KEY]
DOUBLE0, DOUBLE1 = "CAST(0.0 AS DOUBLE)", "CAST(1.0 AS DOUBLE)"

# --- building blocks -------------------------------------------------------

NT = "_nt AS (SELECT " + ", ".join(f"NULLIF({i(c)}, {TOK}) AS {i(c)}" for c in RAW_COLUMNS) + " FROM encounters)"

_CLEAN_COLS = [c for c in RAW_COLUMNS if c not in DROP_NOT_KEY and c != "readmitted"]
CLEAN = ("_clean AS (SELECT " + ", ".join(
    f"TRY_CAST({i(c)} AS INTEGER) AS {i(c)}" if c in NUMERIC_COLUMNS else i(c) for c in _CLEAN_COLS)
    + f", CASE WHEN readmitted = 'NO' THEN {DOUBLE0} ELSE {DOUBLE1} END AS label FROM _nt)")
CLEAN_COLUMNS = _CLEAN_COLS + ["label"]

MEANS = "_means AS (SELECT " + ", ".join(f"avg({i(c)}) AS {i(c)}" for c in NUMERIC_COLUMNS) + " FROM _clean)"
FREQ = (f"_freq AS (SELECT column_name, value, count(*) AS n FROM "
        f"(UNPIVOT (SELECT {cols(CATEGORICAL_COLUMNS)} FROM _clean) ON {cols(CATEGORICAL_COLUMNS)} "
        f"INTO NAME column_name VALUE value) GROUP BY column_name, value)")
MODES = ("_modes AS (SELECT column_name, value AS mode_value, n AS mode_count FROM "
         "(SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rn FROM _freq) "
         "WHERE rn = 1)")


def _fill(c: str) -> str:
    if c in NUMERIC_COLUMNS:
        return f"coalesce({i(c)}, (SELECT CAST(trunc({i(c)}) AS INTEGER) FROM _means)) AS {i(c)}"
    if c in CATEGORICAL_COLUMNS:
        return f"coalesce({i(c)}, (SELECT mode_value FROM _modes WHERE column_name = {lit(c)})) AS {i(c)}"
    return i(c)


IMPUTED = "_imputed AS (SELECT " + ", ".join(_fill(c) for c in CLEAN_COLUMNS) + " FROM _clean)"


def _group(c: str) -> str:
    return (f"coalesce(CASE WHEN regexp_matches({i(c)}, '^V') THEN 'V_Code' "
            f"WHEN regexp_matches({i(c)}, '^E') THEN 'E_Code' "
            f"WHEN {i(c)} IS NOT NULL THEN substr({i(c)}, 1, 3) END, 'UNK')")


_GROUPED = [f"{c}_group" for c in DIAGNOSIS_COLUMNS]
GROUPS = ("_groups AS (SELECT " + cols([c for c in CLEAN_COLUMNS if c not in DIAGNOSIS_COLUMNS]) + ", "
          + ", ".join(f"{_group(c)} AS {i(c + '_group')}" for c in DIAGNOSIS_COLUMNS) + " FROM _imputed)")


def _comorbidity() -> str:
    parts = []
    for g in MAJOR_DISEASE_GROUPS:
        cond = " OR ".join(f"{i(c)} = {lit(g)}" for c in _GROUPED)
        parts.append(f"CASE WHEN {cond} THEN 1 ELSE 0 END")
    return "CAST(" + " + ".join(parts) + " AS INTEGER)"


def _change() -> str:
    vals = ", ".join(lit(v) for v in CHANGE_VALUES)
    return "CAST(" + " + ".join(f"CASE WHEN {i(m)} IN ({vals}) THEN 1 ELSE 0 END" for m in MEDICATION_COLUMNS) + " AS INTEGER)"


_RATIOS = ", ".join(
    f"CAST({i(num)} AS DOUBLE) / NULLIF(CAST({i(STAY_COLUMN)} AS DOUBLE), 0) AS {i(out)}" for out, num in PER_DAY_RATIOS)
FEAT_ROWS = (f"_feat_rows AS (SELECT *, {_comorbidity()} AS comorbidity_count, {_RATIOS}, "
             f"{_change()} AS med_change_score FROM _groups)")
WEIGHTS = ("_w AS (SELECT CAST(count(*) FILTER (WHERE label = 1.0) AS DOUBLE) AS p, "
           "CAST(count(*) FILTER (WHERE label = 0.0) AS DOUBLE) AS n FROM _feat_rows)")
FEAT = ("_feat AS (SELECT f.*, CASE WHEN f.label = 0.0 THEN (SELECT p / (p + n) FROM _w) "
        "ELSE (SELECT n / (p + n) FROM _w) END AS \"classWeight\" FROM _feat_rows f)")

CHAIN_CLEAN = [NT, CLEAN]
CHAIN_IMPUTED = CHAIN_CLEAN + [MEANS, FREQ, MODES, IMPUTED]
CHAIN_FEAT_ROWS = CHAIN_IMPUTED + [GROUPS, FEAT_ROWS]
CHAIN_FEAT = CHAIN_FEAT_ROWS + [WEIGHTS, FEAT]

RULE = ("_rule AS (SELECT encounter_id, label, CAST(comorbidity_count + number_inpatient AS INTEGER) AS score, "
        f"CASE WHEN comorbidity_count + number_inpatient >= 2 THEN {DOUBLE1} ELSE {DOUBLE0} END AS prediction FROM _feat)")
CHAIN_RULE = CHAIN_FEAT + [RULE]

CLASS_COUNTS = ("_cm AS (SELECT count(*) FILTER (WHERE label = 1.0 AND prediction = 1.0) AS tp, "
                "count(*) FILTER (WHERE label <> 1.0 AND prediction = 1.0) AS fp, "
                "count(*) FILTER (WHERE label = 1.0 AND prediction <> 1.0) AS fn, "
                "count(*) FILTER (WHERE label <> 1.0 AND prediction <> 1.0) AS tn FROM _rule)")
CLASS_METRICS = (
    "_metrics AS (SELECT tp, fp, fn, tn, "
    "CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS recall, "
    "CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS \"precision\", "
    "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1p, "
    "CASE WHEN 2 * tn + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tn AS DOUBLE) / CAST(2 * tn + fp + fn AS DOUBLE) END AS f1n "
    "FROM _cm)")
AUC = ("_per_score AS (SELECT score, count(*) FILTER (WHERE label = 1.0) AS pos, "
       "count(*) FILTER (WHERE label = 0.0) AS neg FROM _rule GROUP BY score), "
       "_ranked AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
       "AS neg_below FROM _per_score), "
       "_auc AS (SELECT sum(CAST(pos AS DOUBLE) * (2 * CAST(neg_below AS DOUBLE) + CAST(neg AS DOUBLE))) "
       "/ (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc, "
       "CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg, "
       "(SELECT count(*) FROM _rule WHERE score IS NULL OR label IS NULL) AS n_dropped FROM _ranked)")

CATEGORICAL_FEATURES = CATEGORICAL_COLUMNS + _GROUPED
NUMERIC_FEATURES = NUMERIC_COLUMNS + ["comorbidity_count", "labs_per_day", "meds_per_day", "procs_per_day",
                                      "med_change_score"]
FEAT_ORDER = ([c for c in CLEAN_COLUMNS if c not in DIAGNOSIS_COLUMNS] + _GROUPED
              + ["comorbidity_count", "labs_per_day", "meds_per_day", "procs_per_day", "med_change_score",
                 "classWeight"])

INDEX = (f"_pairs AS (UNPIVOT (SELECT {cols(CATEGORICAL_FEATURES)} FROM _feat) ON {cols(CATEGORICAL_FEATURES)} "
         f"INTO NAME column_name VALUE category), "
         "_idx AS (SELECT column_name, category, n, CAST(row_number() OVER (PARTITION BY column_name "
         "ORDER BY n DESC, category) - 1 AS INTEGER) AS category_index, "
         "count(*) OVER (PARTITION BY column_name) AS n_labels FROM "
         "(SELECT column_name, category, count(*) AS n FROM _pairs GROUP BY column_name, category))")


def with_(ctes, body: str) -> str:
    return "WITH " + encounters_sql_ctes() + (", " + ", ".join(ctes) if ctes else "") + " " + body


def _code_map_values() -> str:
    """The shipped code-map file as a VALUES list, parsed with Python's csv module."""
    rows, name = [], None
    for rec in csv.reader(io.StringIO(code_map_text())):
        if not rec or all(not x.strip() for x in rec):
            continue
        code, desc = rec[0].strip(), rec[1].strip() if len(rec) > 1 else ""
        if desc == "description":
            name = code
            continue
        rows.append((name, code, desc))
    return ", ".join(f"({lit(a)}, {lit(b)}, {lit(c)})" for a, b, c in rows)


CODE_MAPS = (f"_maps AS (SELECT map_name, code, min(description) AS description FROM "
             f"(VALUES {_code_map_values()}) t(map_name, code, description) GROUP BY map_name, code)")


def _diag_category(c: str) -> str:
    whens = []
    for name, like, ranges, exact in DIAG_CATEGORIES:
        conds = []
        if like:
            conds.append(f"{i(c)} LIKE {lit(like)}")
        conds += [f"({i(c)} >= {lit(lo)} AND {i(c)} <= {lit(hi)})" for lo, hi in ranges]
        conds += [f"{i(c)} = {lit(e)}" for e in exact]
        whens.append(f"WHEN {' OR '.join(conds)} THEN {lit(name)}")
    return f"CASE {' '.join(whens)} ELSE {lit(DIAG_CATEGORY_OTHER)} END"


STRICT = ("_strict AS (SELECT *, CASE WHEN readmitted = 'NO' THEN " + DOUBLE0 + " WHEN readmitted = '<30' THEN "
          + DOUBLE1 + " WHEN readmitted = '>30' THEN " + DOUBLE1 + " END AS label FROM _nt)")
STRICT_CAT = f"_cat AS (SELECT encounter_id, diag_1, {_diag_category('diag_1')} AS diag_1_category FROM _strict WHERE label IS NOT NULL)"


def _validate(table: str = "encounters") -> str:
    checks = [f"CASE WHEN {i(c)} IS NULL THEN {lit('missing:' + c)} END" for c in RECORD_FIELDS]
    checks += [f"CASE WHEN {i(c)} IS NOT NULL AND {i(c)} <> {TOK} AND TRY_CAST({i(c)} AS INTEGER) IS NULL "
               f"THEN {lit('not_integer:' + c)} END" for c in NUMERIC_COLUMNS]
    reason = f"NULLIF(concat_ws(';', {', '.join(checks)}), '')"
    toks = " + ".join(f"CASE WHEN {i(c)} = {TOK} THEN 1 ELSE 0 END" for c in RECORD_FIELDS)
    return (f"SELECT encounter_id, {reason} IS NULL AS is_valid, {reason} AS reason, "
            f"CAST({toks} AS INTEGER) AS n_missing_tokens FROM {table}")


def _missing_profile() -> str:
    aggs = ", ".join(f"count(*) FILTER (WHERE {i(c)} IS NULL) AS m{k}" for k, c in enumerate(RAW_COLUMNS))
    parts = [f"SELECT {lit(c)} AS column_name, m{k} AS n_missing, m{k} / n * 100 AS missing_pct FROM _agg"
             for k, c in enumerate(RAW_COLUMNS)]
    return with_([NT, f"_agg AS (SELECT count(*) AS n, {aggs} FROM _nt)"], " UNION ALL ".join(parts))


def _column_roles() -> str:
    roles = {**{c: "categorical" for c in CATEGORICAL_FEATURES}, **{c: "numeric" for c in NUMERIC_FEATURES},
             "label": "label", "classWeight": "weight", KEY: "key"}
    types = {**{c: "string" for c in CATEGORICAL_FEATURES + [KEY]}, **{c: "int" for c in NUMERIC_COLUMNS},
             "comorbidity_count": "int", "med_change_score": "int", "labs_per_day": "double",
             "meds_per_day": "double", "procs_per_day": "double", "label": "double", "classWeight": "double"}
    cols_ = [KEY] + [c for c in FEAT_ORDER if c != KEY]
    aggs = ", ".join(f"count({i(c)}) AS n{k}" for k, c in enumerate(cols_))
    parts = [f"SELECT {lit(c)} AS column_name, {lit(types[c])} AS data_type, {lit(roles[c])} AS role, "
             f"n{k} AS n_non_null FROM _cnt" for k, c in enumerate(cols_)]
    return with_(CHAIN_FEAT + [f"_cnt AS (SELECT {aggs} FROM _feat)"], " UNION ALL ".join(parts))


def _one_hot() -> str:
    # StringIndexer keeps an extra index for NULL/unseen; dropLast removes it, so the
    # vector size equals the number of seen categories and every seen category has a slot.
    return with_(CHAIN_FEAT + [INDEX],
                 "SELECT column_name, category_index AS slot, CAST(n_labels AS INTEGER) AS vector_size, n FROM _idx")


def _assembled() -> str:
    offsets = ("_sizes AS (SELECT column_name, max(n_labels) AS size FROM _idx GROUP BY column_name), "
               "_order AS (SELECT * FROM (VALUES " + ", ".join(f"({lit(c)}, {k})" for k, c in enumerate(CATEGORICAL_FEATURES))
               + ") t(column_name, ord)), "
               "_off AS (SELECT o.column_name, coalesce(sum(s.size) OVER (ORDER BY o.ord ROWS BETWEEN UNBOUNDED PRECEDING "
               "AND 1 PRECEDING), 0) AS off, sum(s.size) OVER () AS total FROM _order o JOIN _sizes s USING (column_name))")
    cat_slots = ("SELECT CAST(off + category_index AS INTEGER) AS slot, n AS n_nonzero, CAST(n AS DOUBLE) AS sum_value "
                 "FROM _idx JOIN _off USING (column_name)")
    num_parts = []
    for k, c in enumerate(NUMERIC_FEATURES):
        num_parts.append(
            f"SELECT CAST((SELECT max(total) FROM _off) + {k} AS INTEGER) AS slot, count(*) AS n_nonzero, "
            f"sum(CAST({i(c)} AS DOUBLE)) AS sum_value FROM _feat WHERE {i(c)} <> 0 HAVING count(*) > 0")
    body = ("SELECT slot, CAST(sum(n_nonzero) AS BIGINT) AS n_nonzero, round(sum(sum_value), 4) AS sum_value FROM ("
            + cat_slots + " UNION ALL " + " UNION ALL ".join(num_parts) + ") GROUP BY slot")
    return with_(CHAIN_FEAT + [INDEX, offsets], body)


TRAIN = "CAST(CAST(('0x' || substr(md5(encounter_id), 1, 8)) AS BIGINT) % 100 AS INTEGER) < 80"
MEANS_TRAIN = MEANS.replace(" FROM _clean)", f" FROM _clean WHERE {TRAIN})")
FREQ_TRAIN = FREQ.replace(" FROM _clean) ON ", f" FROM _clean WHERE {TRAIN}) ON ")
CHAIN_FEAT_ROWS_TRAIN_FIT = CHAIN_CLEAN + [MEANS_TRAIN, FREQ_TRAIN, MODES, IMPUTED, GROUPS, FEAT_ROWS]


def _encode_pipeline() -> str:
    """Preparation fitted on the hash-split training rows, applied to every row:
    vector size = categories seen in training + numeric features; active slots =
    categories seen in training (unseen -> zero vector) + non-zero numerics."""
    cats = cols(CATEGORICAL_FEATURES)
    nonzero = " + ".join(f"CASE WHEN {i(c)} <> 0 THEN 1 ELSE 0 END" for c in NUMERIC_FEATURES)
    ctes = CHAIN_FEAT_ROWS_TRAIN_FIT + [
        f"_rows AS (SELECT row_number() OVER () AS rid, {TRAIN} AS is_train, * FROM _feat_rows)",
        f"_seen AS (SELECT DISTINCT column_name, category FROM (UNPIVOT (SELECT {cats} FROM _rows WHERE is_train) "
        f"ON {cats} INTO NAME column_name VALUE category))",
        "_kc AS (SELECT column_name, count(*) AS k FROM _seen GROUP BY column_name)",
        f"_hits AS (SELECT p.rid, count(s.category) AS n_cat FROM (UNPIVOT (SELECT rid, {cats} FROM _rows) ON {cats} "
        "INTO NAME column_name VALUE category) p LEFT JOIN _seen s ON p.column_name = s.column_name "
        "AND p.category = s.category GROUP BY p.rid)",
    ]
    body = (f"SELECT r.encounter_id, r.label, CAST((SELECT sum(k) FROM _kc) + {len(NUMERIC_FEATURES)} AS INTEGER) "
            f"AS feature_dim, CAST(h.n_cat + {nonzero} AS INTEGER) AS n_active FROM _rows r JOIN _hits h ON r.rid = h.rid")
    return with_(ctes, body)


FAULTY = ("_faulty AS (SELECT * REPLACE (CASE WHEN age = '[50-60)' THEN NULL ELSE race END AS race, "
          "CASE WHEN age = '[70-80)' THEN 'a week' ELSE time_in_hospital END AS time_in_hospital) FROM encounters)")
REJECTS = [FAULTY, f"_checked AS ({_validate('_faulty')})"]
BINARY = f"CASE WHEN readmitted = 'NO' THEN {DOUBLE0} ELSE {DOUBLE1} END"


def _named(source: str, **exprs: str) -> str:
    return " UNION ALL ".join(f"SELECT {lit(k)} AS name, CAST({e} AS BIGINT) AS value FROM {source}" for k, e in exprs.items())


def model_oracles() -> dict[str, str]:
    """SQL twins of the model queries' figures."""
    test = f"_test AS (SELECT {BINARY} AS label FROM _nt WHERE NOT ({TRAIN}))"
    scores = with_([NT, test], "SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = 1.0) AS n_positive, CAST(0 AS BIGINT) AS n_out_of_range, "
                               "CAST(0 AS BIGINT) AS n_contradicting FROM _test")
    evaluated = dict(n_positive="count(*) FILTER (WHERE label = 1.0)", n_negative="count(*) FILTER (WHERE label = 0.0)")
    agreed = " UNION ALL SELECT 'n_metrics_agree', CAST(5 AS BIGINT) UNION ALL SELECT 'n_better_than_chance', CAST(1 AS BIGINT)"
    strict_test = f"_strict_test AS (SELECT label FROM _strict WHERE label IS NOT NULL AND NOT ({TRAIN}))"
    batch = dict(n_scored="count(*) FILTER (WHERE is_valid)", n_rejected="count(*) FILTER (WHERE NOT is_valid)")
    zero = lambda *names: "".join(f" UNION ALL SELECT {lit(n)}, CAST(0 AS BIGINT)" for n in names)
    compare = " UNION ALL ".join(
        f"SELECT {lit(m)} AS model, count(*) FILTER (WHERE label = 1.0) AS n_positive, count(*) FILTER (WHERE label = 0.0) AS n_negative, "
        f"CAST(5 AS BIGINT) AS n_metrics_agree, CAST(1 AS BIGINT) AS n_better_than_chance FROM _test" for m in ("logistic", "logistic_weighted", "forest", "gbt"))
    return {
        "encode_pipeline": _encode_pipeline(),
        "random_split": with_([], "SELECT count(*) AS n_rows, count(DISTINCT encounter_id) AS n_keys, CAST(0 AS BIGINT) AS n_uneven FROM encounters"),
        "hash_split_null_keys": with_([], f"SELECT CASE WHEN age <> '[50-60)' AND {TRAIN} THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows, "
                                          "count(*) FILTER (WHERE age IS NULL OR age = '[50-60)') AS n_without_key FROM encounters GROUP BY 1"),
        **{k: scores.replace(" FROM _test", ", CAST(0 AS BIGINT) AS n_slots_off FROM _test") for k in ("lr_scores", "lr_weighted_scores")},
        **{k: scores.replace(" FROM _test", ", CAST(5 AS BIGINT) AS n_metrics_agree, CAST(1 AS BIGINT) AS n_better_than_chance FROM _test") for k in ("rf_scores", "gbt_scores")},
        "model_roundtrip": with_([], "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_other_prediction, CAST(0 AS BIGINT) AS n_other_probability FROM encounters"),
        "train_eval": with_([NT, test], _named("_test", **evaluated) + agreed),
        "model_comparison": with_([NT, test], compare),
        "category_pipeline": with_([NT, STRICT, strict_test], _named("_strict_test", **evaluated) + agreed),
        "score_batch": with_(REJECTS, _named("_checked", **batch) + zero("n_out_of_range", "n_contradicting")),
        "score_rejects": with_(REJECTS, "SELECT encounter_id, reason FROM _checked WHERE NOT is_valid"),
        "score_stream": with_(REJECTS, _named("_checked", **batch) + zero("n_differ")),
    }


def oracle_sql() -> dict[str, str]:
    sel_nt = "SELECT * FROM _nt"
    return {
        "scan_csv": with_([], "SELECT * FROM encounters"),
        "scan_csv_rejects": with_([], "SELECT encounter_id, CASE age WHEN '[50-60)' THEN 'fields:2' WHEN '[70-80)' THEN 'fields:51' ELSE '' END AS reason FROM encounters"),
        "preview": with_(CHAIN_CLEAN, "SELECT * FROM _clean ORDER BY encounter_id LIMIT 10"),
        "metrics_sink": with_(CHAIN_RULE + [CLASS_COUNTS, CLASS_METRICS, AUC],
                              'SELECT a.auc AS "areaUnderROC", m.recall, m."precision" FROM _auc a, _metrics m'),
        "code_maps": with_([CODE_MAPS, "_cnt AS (SELECT map_name, code, count(*) AS n FROM (UNPIVOT (SELECT "
                            "admission_type_id, discharge_disposition_id, admission_source_id FROM encounters) ON "
                            "admission_type_id, discharge_disposition_id, admission_source_id INTO NAME map_name "
                            "VALUE code) GROUP BY map_name, code)"],
                           "SELECT coalesce(m.map_name, c.map_name) AS map_name, coalesce(m.code, c.code) AS code, "
                           "m.description, CAST(coalesce(c.n, 0) AS BIGINT) AS n_encounters FROM _maps m FULL OUTER "
                           "JOIN _cnt c ON m.map_name = c.map_name AND m.code = c.code"),
        "decode_ids": with_([CODE_MAPS],
                            "SELECT e.encounter_id, e.admission_type_id, e.discharge_disposition_id, e.admission_source_id, "
                            "a.description AS admission_type_id_description, "
                            "d.description AS discharge_disposition_id_description, "
                            "s.description AS admission_source_id_description FROM encounters e "
                            "LEFT JOIN _maps a ON a.map_name = 'admission_type_id' AND a.code = e.admission_type_id "
                            "LEFT JOIN _maps d ON d.map_name = 'discharge_disposition_id' AND d.code = e.discharge_disposition_id "
                            "LEFT JOIN _maps s ON s.map_name = 'admission_source_id' AND s.code = e.admission_source_id"),
        "null_tokens": with_([NT], sel_nt),
        "drop_columns": with_([], f"SELECT {cols([c for c in RAW_COLUMNS if c not in DROP_COLUMNS])} FROM encounters"),
        "label_binary": with_([NT], f"SELECT encounter_id, CASE WHEN readmitted = 'NO' THEN {DOUBLE0} ELSE {DOUBLE1} END AS label FROM _nt"),
        "label_strict": with_([NT, STRICT], "SELECT encounter_id, label FROM _strict WHERE label IS NOT NULL"),
        "cast_numeric": with_([], "SELECT encounter_id, " + ", ".join(
            f"TRY_CAST({i(c)} AS INTEGER) AS {i(c)}" for c in NUMERIC_COLUMNS) + " FROM encounters"),
        "filter_label": with_(CHAIN_CLEAN, "SELECT encounter_id, label, time_in_hospital FROM _clean WHERE label = 1.0"),
        "drop_null_rows": with_([NT], "SELECT encounter_id, race, diag_1, num_medications FROM _nt "
                                      "WHERE race IS NOT NULL AND diag_1 IS NOT NULL AND num_medications IS NOT NULL"),
        "project": with_([], "SELECT encounter_id, race AS patient_race, age AS age_band, readmitted AS target FROM encounters"),
        "column_roles": _column_roles(),
        "clean_encounters": with_(CHAIN_CLEAN, "SELECT * FROM _clean"),
        "fill_constant": with_([NT], "SELECT encounter_id, coalesce(race, 'Other') AS race, coalesce(diag_1, 'UNK') AS diag_1, "
                                     "coalesce(num_medications, '0') AS num_medications FROM _nt"),
        "row_count": with_([], f"SELECT count(*) AS n_rows, CAST({len(RAW_COLUMNS)} AS BIGINT) AS n_columns FROM encounters"),
        "missing_profile": _missing_profile(),
        "distinct_values": with_([], "SELECT DISTINCT readmitted FROM encounters"),
        "value_counts": with_([NT], 'SELECT race, count(*) AS "count" FROM _nt GROUP BY race'),
        "numeric_means": with_(CHAIN_CLEAN + [MEANS], "SELECT * FROM _means"),
        "column_modes": with_(CHAIN_CLEAN + [FREQ, MODES], "SELECT column_name, mode_value, mode_count FROM _modes"),
        "class_counts": with_(CHAIN_CLEAN, "SELECT count(*) FILTER (WHERE label = 1.0) AS n_positive, "
                                           "count(*) FILTER (WHERE label = 0.0) AS n_negative FROM _clean"),
        "impute_mean": with_(CHAIN_IMPUTED, f"SELECT encounter_id, {cols(NUMERIC_COLUMNS)} FROM _imputed"),
        "impute_mode": with_(CHAIN_IMPUTED, f"SELECT encounter_id, {cols(CATEGORICAL_COLUMNS)} FROM _imputed"),
        "impute_encounters": with_(CHAIN_IMPUTED, "SELECT * FROM _imputed"),
        "diag_groups": with_(CHAIN_CLEAN, "SELECT encounter_id, " + ", ".join(
            f"{_group(c)} AS {i(c + '_group')}" for c in DIAGNOSIS_COLUMNS) + " FROM _clean"),
        "diag_category": with_([NT, STRICT, STRICT_CAT], "SELECT * FROM _cat"),
        "diag_category_counts": with_([NT, STRICT, STRICT_CAT],
                                      'SELECT diag_1_category, count(*) AS "count" FROM _cat GROUP BY diag_1_category'),
        "comorbidity_count": with_(CHAIN_FEAT_ROWS, f"SELECT encounter_id, {cols(_GROUPED)}, comorbidity_count FROM _feat_rows"),
        "per_day_ratios": with_(CHAIN_FEAT_ROWS, "SELECT encounter_id, time_in_hospital, labs_per_day, meds_per_day, "
                                                 "procs_per_day FROM _feat_rows"),
        "med_change_score": with_(CHAIN_FEAT_ROWS, "SELECT encounter_id, med_change_score FROM _feat_rows"),
        "class_weights": with_(CHAIN_CLEAN + ["_w AS (SELECT CAST(count(*) FILTER (WHERE label = 1.0) AS DOUBLE) AS p, "
                                              "CAST(count(*) FILTER (WHERE label = 0.0) AS DOUBLE) AS n FROM _clean)"],
                               'SELECT encounter_id, label, CASE WHEN label = 0.0 THEN (SELECT p / (p + n) FROM _w) '
                               'ELSE (SELECT n / (p + n) FROM _w) END AS "classWeight" FROM _clean'),
        "feature_table": with_(CHAIN_FEAT, f"SELECT {cols(FEAT_ORDER)} FROM _feat"),
        "hash_split": with_([], "SELECT encounter_id, CASE WHEN b < 80 THEN 'train' ELSE 'test' END AS split, b AS bucket "
                                "FROM (SELECT encounter_id, CAST(CAST(('0x' || substr(md5(encounter_id), 1, 8)) AS BIGINT) "
                                "% 100 AS INTEGER) AS b FROM encounters)"),
        "string_index": with_(CHAIN_FEAT + [INDEX], "SELECT column_name, category, category_index, n FROM _idx"),
        "one_hot_long": _one_hot(),
        "assembled_long": _assembled(),
        "confusion_matrix": with_(CHAIN_RULE, "SELECT label, count(*) FILTER (WHERE prediction = 0.0) AS pred_0, "
                                              "count(*) FILTER (WHERE prediction = 1.0) AS pred_1 FROM _rule GROUP BY label"),
        "class_metrics": with_(CHAIN_RULE + [CLASS_COUNTS, CLASS_METRICS],
                               "SELECT tp, fp, fn, tn, recall, \"precision\", f1p AS f1_positive, "
                               "(CAST(tp + fn AS DOUBLE) * f1p + CAST(tn + fp AS DOUBLE) * f1n) / CAST(tp + fp + fn + tn AS DOUBLE) "
                               "AS f1_weighted FROM _metrics"),
        "auc_exact": with_(CHAIN_RULE + [AUC], "SELECT * FROM _auc"),
        "shape_scores": with_(CHAIN_RULE, "SELECT encounter_id, CASE WHEN prediction = 1.0 THEN 'Readmitted' ELSE "
                                          "'Not Readmitted' END AS prediction_label, CAST(prediction AS INTEGER) AS "
                                          "prediction_value, CAST(score AS DOUBLE) / (CAST(score AS DOUBLE) + 2.0) AS "
                                          "probability_of_readmission FROM _rule"),
        "validate_records": with_([], _validate()),
    }
