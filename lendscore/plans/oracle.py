"""DuckDB oracle SQL for the registered queries (same column names)."""

from __future__ import annotations

from ..sources.applications import APPLICATIONS_SQL

ORACLE: dict[str, str] = {}

RAW = f"""raw AS (
  SELECT "CustomerId", "Age", "Sex", "Job", "Housing",
         "Saving accounts" AS Saving_accounts, "Checking account" AS Checking_account,
         "Credit amount" AS Credit_amount, "Duration", "Purpose", "Risk"
  FROM ({APPLICATIONS_SQL}) a)"""

FEATURES = RAW + """,
cleaned AS (
  SELECT CustomerId, Age, Sex, Job,
    CASE WHEN Housing IN ('free', 'rent') THEN 'non-own' ELSE Housing END AS Housing,
    COALESCE(CASE WHEN Saving_accounts = 'quite rich' THEN 'rich'
                  ELSE NULLIF(Saving_accounts, 'NA') END, 'no account/unknown') AS Saving_accounts,
    COALESCE(NULLIF(Checking_account, 'NA'), 'no account/unknown') AS Checking_account,
    Credit_amount, Duration,
    CASE WHEN Purpose IN ('domestic appliances', 'repairs', 'vacation/others') THEN 'other'
         ELSE Purpose END AS Purpose,
    Risk
  FROM raw),
features AS (
  SELECT CustomerId, Age, Sex, Job, Housing, Saving_accounts, Checking_account,
    Credit_amount, Duration, Purpose,
    CAST(CASE Risk WHEN 'good' THEN 0 WHEN 'bad' THEN 1 END AS INT) AS Risk,
    CAST(CASE Saving_accounts WHEN 'little' THEN 0 WHEN 'moderate' THEN 1
         WHEN 'no account/unknown' THEN 2 WHEN 'rich' THEN 3 END AS INT) AS Saving_accounts_ordinal_enc,
    CAST(CASE Checking_account WHEN 'little' THEN 0 WHEN 'moderate' THEN 1
         WHEN 'rich' THEN 2 WHEN 'no account/unknown' THEN 3 END AS INT) AS Checking_account_ordinal_enc
  FROM cleaned)"""


def with_features(body: str, extra: str = "") -> str:
    return f"WITH {FEATURES}{extra}\n{body}"


def with_raw(body: str, extra: str = "") -> str:
    return f"WITH {RAW}{extra}\n{body}"


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


# --- 2.2 cleaning and encoding -------------------------------------------
sql("feature_table", with_features("SELECT * FROM features"))
sql("normalize_columns", with_raw("SELECT * FROM raw"))
sql("nullify_tokens", with_raw("""
SELECT * REPLACE (NULLIF(Saving_accounts, 'NA') AS Saving_accounts,
                  NULLIF(Checking_account, 'NA') AS Checking_account) FROM raw"""))
sql("collapse_categories", with_raw("""
SELECT * REPLACE (
  CASE WHEN Saving_accounts = 'quite rich' THEN 'rich' ELSE Saving_accounts END AS Saving_accounts,
  CASE WHEN Housing IN ('free', 'rent') THEN 'non-own' ELSE Housing END AS Housing,
  CASE WHEN Purpose IN ('domestic appliances', 'repairs', 'vacation/others') THEN 'other'
       ELSE Purpose END AS Purpose) FROM raw"""))
sql("fill_missing", with_raw("""
SELECT * REPLACE (
  COALESCE(NULLIF(Saving_accounts, 'NA'), 'no account/unknown') AS Saving_accounts,
  COALESCE(NULLIF(Checking_account, 'NA'), 'no account/unknown') AS Checking_account) FROM raw"""))
sql("map_values", with_raw("""
SELECT * REPLACE (CASE Risk WHEN 'good' THEN '0' WHEN 'bad' THEN '1' ELSE Risk END AS Risk) FROM raw"""))
sql("ordinal_encode", with_features("""
SELECT r.* REPLACE (f.Saving_accounts AS Saving_accounts, f.Checking_account AS Checking_account),
       f.Saving_accounts_ordinal_enc, f.Checking_account_ordinal_enc
FROM raw r JOIN features f USING (CustomerId)"""))
sql("label_encode", with_raw("""
SELECT * REPLACE (CAST(CASE Risk WHEN 'good' THEN 0 WHEN 'bad' THEN 1 END AS INT) AS Risk) FROM raw"""))
sql("select_features", with_features("""
SELECT CustomerId, Credit_amount, Duration, Age, Sex, Job, Housing, Purpose,
       Saving_accounts_ordinal_enc, Checking_account_ordinal_enc, Risk FROM features"""))
sql("nan_to_null", with_features("""
SELECT CustomerId, CASE WHEN Job = 0 THEN NULL ELSE Credit_amount END AS Credit_amount FROM features"""))
sql("decode_label", with_features("""
SELECT CustomerId, Risk, CASE WHEN Risk = 1 THEN 'bad' ELSE 'good' END AS Risk_label FROM features"""))
sql("preview", with_features("SELECT * FROM features ORDER BY CustomerId LIMIT 10"))


# --- 2.5 splits and sampling ---------------------------------------------
RANKED = """,
hashed AS (SELECT *, md5(CAST(CustomerId AS VARCHAR) || ':42') AS h FROM features),
ranked AS (SELECT *, row_number() OVER (PARTITION BY Risk ORDER BY h, CustomerId) AS rn,
                  count(*) OVER (PARTITION BY Risk) AS tot FROM hashed)"""
sql("stratified_split", with_features(
    "SELECT CustomerId, Risk, rn <= (2 * tot + 5) // 10 AS is_test FROM ranked", RANKED))
sql("stratified_folds", with_features(
    "SELECT CustomerId, CAST((rn - 1) % 5 AS INT) AS fold FROM ranked", RANKED))
sql("sample_n_replace", with_features("""
SELECT d.draw, i.CustomerId, i.Credit_amount, i.Duration, i.Age, i.Sex, i.Job, i.Housing,
       i.Purpose, i.Saving_accounts_ordinal_enc, i.Checking_account_ordinal_enc
FROM (SELECT range AS draw,
             ('0x' || substr(md5(CAST(range AS VARCHAR) || ':7'), 1, 15))::BIGINT
               % (SELECT count(*) FROM features) + 1 AS rn
      FROM range(100)) d
JOIN (SELECT *, row_number() OVER (ORDER BY h, CustomerId) AS rn FROM
        (SELECT *, md5(CAST(CustomerId AS VARCHAR) || ':42') AS h FROM features)) i
  ON d.rn = i.rn"""))


# --- 2.3 profiling and aggregation ---------------------------------------
PROFILE_NUM = ["Credit_amount", "Duration", "Age", "Job", "Saving_accounts_ordinal_enc",
               "Checking_account_ordinal_enc", "Risk"]
PROFILE_COLS = ["Credit_amount", "Duration", "Age", "Sex", "Job", "Housing", "Purpose",
                "Saving_accounts", "Checking_account", "Saving_accounts_ordinal_enc",
                "Checking_account_ordinal_enc", "Risk"]
CATEGORY_COLS = ["Sex", "Job", "Housing", "Purpose", "Saving_accounts", "Checking_account"]
CATEGORICAL_FEATURES = ["Sex", "Job", "Housing", "Purpose", "Saving_accounts_ordinal_enc",
                        "Checking_account_ordinal_enc"]


def _profile_part(c: str) -> str:
    if c in PROFILE_NUM:
        x = f"CAST({c} AS DOUBLE)"
        stats = (f"avg({x}) AS mean, stddev_samp({x}) AS stddev, min({x}) AS min, "
                 f"quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
                 f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max")
    else:
        stats = ", ".join(f"CAST(NULL AS DOUBLE) AS {s}"
                          for s in ("mean", "stddev", "min", "p25", "p50", "p75", "max"))
    return (f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
            f"count(DISTINCT {c}) AS n_distinct, {stats} FROM features")


sql("profile_columns", with_features("\nUNION ALL\n".join(_profile_part(c) for c in PROFILE_COLS) + """
UNION ALL
SELECT 'Nothing' AS column_name, count(*) AS n_rows, count(*) AS n_null, CAST(0 AS BIGINT) AS n_distinct,
       CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min,
       CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75,
       CAST(NULL AS DOUBLE) AS max FROM features"""))
sql("cardinality_plan", with_features("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, "
    f"CASE WHEN count(DISTINCT {c}) > 2 THEN 'one_hot' WHEN count(DISTINCT {c}) = 2 THEN 'binary' "
    f"ELSE 'drop' END AS encoder FROM features" for c in CATEGORICAL_FEATURES)))
_STATS = ",\nstats AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n, "
    f"CAST(sum(Risk) AS BIGINT) AS positives, sum(Risk) / count(*) AS target_rate FROM features GROUP BY {c}"
    for c in CATEGORY_COLS) + ")"
sql("target_rate", with_features("SELECT * FROM stats", _STATS))
sql("category_share", with_features(
    "SELECT column_name, value, n, n / (SELECT count(*) FROM features) AS share FROM stats", _STATS))
sql("derive_ordinal", with_features("""
SELECT column_name, value, target_rate,
       CAST(row_number() OVER (PARTITION BY column_name ORDER BY target_rate, value) - 1 AS INT) AS code
FROM stats WHERE column_name IN ('Saving_accounts', 'Checking_account') AND value IS NOT NULL""", _STATS))


# --- 2.3 / 2.6 dictionaries, scaler and encoders (fit on train, apply to test)
NUMERICAL = ["Credit_amount", "Duration", "Age"]
SPLIT = RANKED + """,
train AS (SELECT * FROM ranked WHERE rn > (2 * tot + 5) // 10),
test AS (SELECT * FROM ranked WHERE rn <= (2 * tot + 5) // 10)"""


def _sorted(c: str) -> str:
    return f"(SELECT array_sort(list(DISTINCT {c})) FROM train)"


sql("category_dictionary", with_features("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, "
    f"CAST(row_number() OVER (ORDER BY {c}) - 1 AS INT) AS code "
    f"FROM (SELECT DISTINCT {c} FROM train WHERE {c} IS NOT NULL)" for c in CATEGORICAL_FEATURES), SPLIT))
sql("scaler_stats", with_features("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, avg(CAST({c} AS DOUBLE)) AS mean, "
    f"stddev_pop(CAST({c} AS DOUBLE)) AS std FROM train" for c in NUMERICAL), SPLIT))
sql("standard_scale", with_features("SELECT CustomerId, " + ", ".join(
    f"(CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM train)) / "
    f"(SELECT stddev_pop(CAST({c} AS DOUBLE)) FROM train) AS {c}" for c in NUMERICAL)
    + " FROM test", SPLIT))
ONE_HOT_SLOTS = {"Job": 4, "Purpose": 4, "Saving_accounts_ordinal_enc": 4,
                 "Checking_account_ordinal_enc": 4}
sql("one_hot", with_features("SELECT CustomerId, " + ", ".join(
    f"COALESCE(CAST({c} = {_sorted(c)}[{i + 1}] AS INT), 0) AS {c}_oh{i}"
    for c, k in ONE_HOT_SLOTS.items() for i in range(k)) + " FROM test", SPLIT))
sql("binary_encode", with_features("SELECT CustomerId, " + ", ".join(
    f"CAST(list_position({_sorted(c)}, {c}) - 1 AS INT) AS {c}_bin" for c in ("Sex", "Housing"))
    + " FROM test", SPLIT))
sql("category_codes", with_features("SELECT CustomerId, " + ", ".join(
    f"CAST(COALESCE(list_position({_sorted(c)}, {c}) - 1, -1) AS INT) AS {c}_code"
    for c in CATEGORICAL_FEATURES) + " FROM test", SPLIT))


# --- 2.7 metrics on deterministic evaluation scores --------------------------
def _noise(seed: int) -> str:
    return f"('0x' || substr(md5(CAST(CustomerId AS VARCHAR) || ':{seed}'), 1, 3))::BIGINT"


SCORED = SPLIT + f""",
scored AS (SELECT CustomerId, Risk, rn <= (2 * tot + 5) // 10 AS is_test, CAST((rn - 1) % 5 AS INT) AS fold,
                  ({_noise(1)} + Risk * 1500) / 5595.0 AS score_challenger,
                  ({_noise(2)} + Risk * 800) / 4895.0 AS score_champion FROM ranked),
stest AS (SELECT * FROM scored WHERE is_test)"""


def _curve(src: str, score: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    sel = f"{by}, " if by else ""
    return f"""(SELECT *, sum(pos) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
        sum(neg) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
        sum(pos) OVER ({part}) AS n_pos, sum(neg) OVER ({part}) AS n_neg
  FROM (SELECT {sel}{score} AS score, sum(Risk) AS pos, count(*) - sum(Risk) AS neg
        FROM {src} GROUP BY {sel}{score}))"""


AP = "sum(pos / n_pos * tp / (tp + fp))"
ROC = "sum(neg * ((tp - pos) + pos / 2.0)) / (first(n_pos) * first(n_neg))"
PRAUC = ("sum(pos / n_pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN 1.0 "
         "ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2)")
sql("average_precision", with_features(
    f"SELECT {AP} AS average_precision FROM {_curve('stest', 'score_challenger')}", SCORED))
sql("roc_auc", with_features(f"SELECT {ROC} AS roc_auc FROM {_curve('stest', 'score_challenger')}", SCORED))
sql("pr_auc", with_features(f"SELECT {PRAUC} AS pr_auc FROM {_curve('stest', 'score_challenger')}", SCORED))
sql("confusion_metrics", with_features("""
SELECT tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
       n AS example_count, (tp + tn) / n AS accuracy_score,
       COALESCE(tp / NULLIF(tp + fp, 0), 0.0) AS precision_score,
       COALESCE(tp / NULLIF(tp + fn, 0), 0.0) AS recall_score,
       COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0.0) AS f1_score
FROM (SELECT count(*) FILTER (WHERE Risk = 1 AND score_challenger > 0.5) AS tp,
             count(*) FILTER (WHERE Risk <> 1 AND score_challenger > 0.5) AS fp,
             count(*) FILTER (WHERE Risk <> 1 AND NOT score_challenger > 0.5) AS tn,
             count(*) FILTER (WHERE Risk = 1 AND NOT score_challenger > 0.5) AS fn,
             count(*) AS n FROM stest)""", SCORED))
sql("log_loss", with_features("""
SELECT -avg(Risk * ln(p) + (1 - Risk) * ln(1 - p)) AS log_loss, count(*) AS example_count
FROM (SELECT Risk, least(greatest(score_challenger, 1e-15), 1 - 1e-15) AS p FROM stest)""", SCORED))
sql("promotion_gate", with_features(f"""
SELECT 'pr_auc' AS metric, c.v AS challenger_value, h.v AS champion_value, c.v >= h.v AS promote
FROM (SELECT {PRAUC} AS v FROM {_curve('stest', 'score_challenger')}) c,
     (SELECT {PRAUC} AS v FROM {_curve('stest', 'score_champion')}) h""", SCORED))

TRIAL_WEIGHTS = (300, 800, 1500, 2500)
TRIALS = SCORED + ",\ntrial_scores AS (" + "\nUNION ALL\n".join(
    f"SELECT {t} AS trial, fold, Risk, ({_noise(10 + t)} + Risk * {w}) / {4095.0 + w} AS score "
    f"FROM scored WHERE NOT is_test" for t, w in enumerate(TRIAL_WEIGHTS)) + f"""),
fold_ap AS (SELECT trial, fold, {AP} AS average_precision
            FROM {_curve('trial_scores', 'score', 'trial, fold')} GROUP BY trial, fold),
cv AS (SELECT trial, avg(average_precision) AS mean_score, count(*) AS n_folds FROM fold_ap GROUP BY trial)"""
sql("cv_mean_score", with_features("SELECT * FROM cv", TRIALS))
sql("best_trial", with_features(
    "SELECT trial, mean_score FROM cv ORDER BY mean_score DESC, trial LIMIT 1", TRIALS))
sql("latest_version", with_features("""
SELECT 'credit-model' AS model_name, CAST(count(*) AS BIGINT) AS version,
       'models/credit-model/' || CAST(max(trial) AS VARCHAR) AS path, CAST(max(trial) AS VARCHAR) AS run_id
FROM (SELECT trial, mean_score,
             max(mean_score) OVER (ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
      FROM cv)
WHERE best_before IS NULL OR mean_score >= best_before""", TRIALS))
sql("best_run", with_features("""
SELECT run_name, trial, precision_recall_score FROM (
  SELECT 'hyperparameter_tuning_' || trial AS run_name, CAST(trial AS BIGINT) AS trial,
         mean_score AS precision_recall_score FROM cv
  UNION ALL
  SELECT 'trial_' || trial || '_fold_' || fold, CAST(trial AS BIGINT), average_precision FROM fold_ap)
WHERE run_name LIKE 'hyperparameter_tuning_%'
ORDER BY precision_recall_score DESC, run_name LIMIT 1""", TRIALS))


# --- 2.7 fixed-coefficient scorer --------------------------------------------
_Z = ("-0.5 + CAST(Credit_amount AS DOUBLE) * 1e-05 + CAST(Duration AS DOUBLE) * 0.02 "
      "+ CAST(Age AS DOUBLE) * -0.01 + CAST(Saving_accounts_ordinal_enc AS DOUBLE) * -0.15 "
      "+ CAST(Checking_account_ordinal_enc AS DOUBLE) * 0.1")
LINEAR = f""",
linear AS (SELECT CustomerId, 1.0 / (1.0 + exp(-({_Z}))) AS p_positive FROM features)"""
LINEAR_BODY = """SELECT CustomerId, p_positive, CAST(p_positive > 0.5 AS INT) AS prediction,
       CASE WHEN p_positive > 0.5 THEN 'bad' ELSE 'good' END AS "Credit risk prediction" FROM linear"""
sql("linear_score", with_features(LINEAR_BODY, LINEAR))
sql("stream_score", with_features(LINEAR_BODY, LINEAR))
_JSON_COLS = ["Credit_amount", "Duration", "Age", "Sex", "Job", "Housing", "Purpose",
              "Saving_accounts_ordinal_enc", "Checking_account_ordinal_enc"]
sql("to_json_records", with_features(
    "SELECT CAST(to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in _JSON_COLS)
    + ")) AS VARCHAR) AS record FROM features"))


# --- 2.1 sources and sinks ---------------------------------------------------------
sql("csv_roundtrip", "SELECT *, CASE CustomerId % 3 WHEN 0 THEN 'said \"yes, please\",' || chr(10) || 'then left' "
                     "WHEN 1 THEN '  padded ' END AS Note FROM (" + ORACLE["nullify_tokens"] + ")")
sql("feature_table_roundtrip", ORACLE["feature_table"])
sql("key_violations", with_features("""
SELECT 'not_null:CustomerId' AS rule, CAST(count(*) - count(CustomerId) AS BIGINT) AS violations,
       'features' AS table_name FROM features
UNION ALL
SELECT 'primary_key:CustomerId', CAST(COALESCE(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT), 'features'
FROM (SELECT count(*) AS n FROM features WHERE CustomerId IS NOT NULL GROUP BY CustomerId)
UNION ALL
SELECT 'not_null:l_orderkey', CAST(count(*) - count(l_orderkey) AS BIGINT), 'lineitem' FROM lineitem
UNION ALL
SELECT 'primary_key:l_orderkey', CAST(COALESCE(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT), 'lineitem'
FROM (SELECT count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey)"""))
sql("latest_snapshot", with_features("SELECT * REPLACE (CAST(Job AS VARCHAR) AS Job), "
                                     "Age - 18 AS Adult_years FROM features WHERE Job < 3"))
_DIGEST_COLS = ["CustomerId", "Age", "Sex", "Job", "Housing", "Saving_accounts", "Checking_account",
                "Credit_amount", "Duration", "Purpose", "Risk", "Saving_accounts_ordinal_enc",
                "Checking_account_ordinal_enc"]


def _canonical(c: str) -> str:
    if c == "Credit_amount":
        near = f"floor(log2(abs({c})))"
        e = (f"({near} - CASE WHEN abs({c}) < pow(2.0, {near}) THEN 1 ELSE 0 END"
             f" + CASE WHEN abs({c}) >= pow(2.0, {near}) * 2 THEN 1 ELSE 0 END)")
        text = (f"CASE WHEN {c} = 0 THEN '0' ELSE CASE WHEN {c} < 0 THEN '-' ELSE '' END || "
                f"CAST(abs({c}) * pow(2.0, 52 - {e}) AS BIGINT) || 'e' || CAST({e} AS BIGINT) END")
    else:
        text = rf"replace(replace(CAST({c} AS VARCHAR), '\', '\\'), '|', '\p')"
    return rf"COALESCE({text}, '\N')"


_ROWTEXT = "concat_ws('|', " + ", ".join(map(_canonical, _DIGEST_COLS)) + ")"
sql("dataset_lineage", with_features(f"""
SELECT 'run-0' AS run_id, 'credit_features' AS table_name, CAST(0 AS BIGINT) AS snapshot_id,
       context, count(*) AS n_rows,
       CAST(sum(('0x' || substr(md5({_ROWTEXT}), 1, 14))::BIGINT) AS VARCHAR) AS digest
FROM (SELECT *, CASE WHEN rn <= (2 * tot + 5) // 10 THEN 'testing' ELSE 'training' END AS context
      FROM ranked) GROUP BY context""", RANKED))


sql("snapshot_diff", """
SELECT o_orderkey, 'removed' AS change FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT o_orderkey, 'changed' FROM orders WHERE o_orderkey % 50 != 0 AND o_orderkey % 49 = 1
UNION ALL SELECT o_orderkey + 1000000000, 'added' FROM orders WHERE o_orderkey % 51 = 0""")
sql("snapshot_history", """
SELECT CAST(0 AS BIGINT) AS snapshot_id, 'create' AS operation, count(*) AS n_rows FROM orders
UNION ALL SELECT CAST(1 AS BIGINT), 'update', count(*) FILTER (WHERE o_orderkey % 50 != 0) + count(*) FILTER (WHERE o_orderkey % 51 = 0)
FROM orders""")
# Exact order: whole numbers beyond 2^53 and decimals of 20 digits.
sql("dictionary_exact", """
WITH o AS (SELECT 9007199254740990 + o_orderkey - 2 * (o_orderkey % 2) * (9007199254740990 + o_orderkey) AS big,
                  CAST(100000000000000000000.00 AS DECIMAL(38, 2)) + CAST(o_custkey AS DECIMAL(18, 2)) AS dec FROM orders)
SELECT 'big' AS column_name, CAST(big AS VARCHAR) AS value, CAST(row_number() OVER (ORDER BY big) - 1 AS INT) AS code
FROM (SELECT DISTINCT big FROM o)
UNION ALL
SELECT 'dec', CAST(dec AS VARCHAR), CAST(row_number() OVER (ORDER BY dec) - 1 AS INT) FROM (SELECT DISTINCT dec FROM o)""")
_LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
sql("one_hot_many", f"""
WITH d AS (SELECT l_orderkey, CAST(row_number() OVER (ORDER BY l_orderkey) - 1 AS INT) AS slot
           FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber = 1))
SELECT {_LINE_KEYS}, 'l_orderkey' AS column_name, slot FROM lineitem JOIN d USING (l_orderkey)""")
sql("composite_split", f"""
WITH h AS (SELECT {_LINE_KEYS}, l_returnflag,
                  md5(concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in _LINE_KEYS.split(', '))}) || ':42') AS h
           FROM lineitem),
     r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY h, {_LINE_KEYS}) AS rn,
                  count(*) OVER (PARTITION BY l_returnflag) AS tot FROM h)
SELECT {_LINE_KEYS}, l_returnflag, rn <= (2 * tot + 5) // 10 AS is_test, CAST((rn - 1) % 5 AS INT) AS fold FROM r""")
sql("schema_check", with_features("SELECT CustomerId, CAST(Age AS BIGINT) AS Age, Credit_amount, "
                                  "CAST(Job AS DOUBLE) AS Job FROM features"))
sql("registry_versions", """
SELECT 'model' AS model_name, row_number() OVER (ORDER BY o_orderpriority) AS version,
       'models/' || o_orderpriority AS path, o_orderpriority AS run_id, o_orderpriority AS priority
FROM (SELECT DISTINCT o_orderpriority FROM orders)""")


# --- the same operators on a second, imbalanced dataset ----------------------------
DOCS = """WITH ld AS (SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, d.n_chars
                FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
sql("quality_split", DOCS + """
SELECT doc_id, quality, rn <= (2 * tot + 5) // 10 AS is_test, CAST((rn - 1) % 5 AS INT) AS fold
FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) AS rn,
             count(*) OVER (PARTITION BY quality) AS tot FROM ld)""")
sql("quality_target_rate", DOCS + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n, "
    f"CAST(sum(quality) AS BIGINT) AS positives, sum(quality) / count(*) AS target_rate FROM ld GROUP BY {c}"
    for c in ("lang", "source")))
sql("toxic_length_metrics", DOCS + """,
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg
      FROM (SELECT CAST(n_chars AS DOUBLE) AS score, sum(toxic) AS pos, count(*) - sum(toxic) AS neg
            FROM ld GROUP BY 1))
SELECT """ + AP + " AS average_precision, " + ROC + " AS roc_auc, " + PRAUC + " AS pr_auc FROM c")


sql("merged_profile", with_features("\nUNION ALL\n".join(
    [f"SELECT '{n}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, avg(CAST({c} AS DOUBLE)) AS mean, "
     f"stddev_samp(CAST({c} AS DOUBLE)) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM features"
     for n, c in (("Amount", "CASE WHEN CustomerId % 7 != 0 THEN Credit_amount END"), ("Duration", "Duration"), ("Age", "Age"))]
    + ["SELECT 'Sex', count(*), count(*) - count(Sex), NULL, NULL, NULL, NULL FROM features"])))


# --- M1-M3, F5, F6, M10 on fitted models -----------------------------------------
sql("baseline_optimality", with_features(
    "SELECT count(*) AS n_rows, TRUE AS gradient_vanishes, TRUE AS gap_closes FROM train", SPLIT))
sql("assembled_features", with_features("\nUNION ALL\n".join(
    [f"SELECT CustomerId, {i} AS slot, (CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM train)) / "
     f"(SELECT stddev_pop(CAST({c} AS DOUBLE)) FROM train) AS value FROM test" for i, c in enumerate(NUMERICAL)]
    + [f"SELECT CustomerId, {i} AS slot, CAST(COALESCE(list_position({_sorted(c)}, {c}) - 1, -1) AS DOUBLE) AS value FROM test"
       for i, c in enumerate(CATEGORICAL_FEATURES, len(NUMERICAL))]), SPLIT))


def _draw(name: str) -> str:
    return f"(('0x' || substr(md5(i || ':{name}:42'), 1, 13))::BIGINT / 4503599627370496.0)"


sql("tune_trials", f"""
SELECT CAST(i AS INT) AS trial, CAST(100 + floor({_draw('n_estimators')} * 401) AS INT) AS n_estimators,
       exp(ln(0.001) + {_draw('learning_rate')} * (ln(0.05) - ln(0.001))) AS learning_rate,
       CAST(8 + floor({_draw('num_leaves')} * 249) AS INT) AS num_leaves, 0.5 + {_draw('subsample')} * 0.5 AS subsample,
       {_draw('reg_lambda')} AS reg_lambda, (SELECT count(*) > 0 FROM orders) AS scored
FROM range(100) AS r(i)""")


def _first_split(numbers: list[str]) -> str:
    """The split with the largest gain over ``numbers`` (by value) and codes (by gradient over hessian)."""
    codes = ["Job", "Purpose", "Saving_accounts_ordinal_enc", "Checking_account_ordinal_enc"]
    bins = "\nUNION ALL\n".join(
        f"SELECT {f} AS f, CAST({c} AS VARCHAR) AS v, {'CAST(' + c + ' AS DOUBLE)' if c in numbers else 'NULL'} AS num, "
        f"row_number() OVER (ORDER BY {c}) AS k, count(*) AS n, sum(Risk) AS pos FROM train GROUP BY {c}"
        for f, c in enumerate(numbers + codes))
    test = " ".join(f"WHEN {f} THEN CAST({c} AS VARCHAR)" for f, c in enumerate(numbers + codes))
    return SPLIT + f""",
base AS (SELECT count(*) AS n, sum(Risk) AS pos, avg(CAST(Risk AS DOUBLE)) AS p FROM train),
bins AS ({bins}),
grads AS (SELECT f, v, k, num, b.n, b.n * p - b.pos AS g, b.n * p * (1 - p) AS h FROM bins b, base),
sums AS (SELECT *, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER a AS nt, sum(g) OVER a AS gt,
                sum(h) OVER a AS ht FROM grads
         WINDOW w AS (PARTITION BY f ORDER BY coalesce(num, g / (h + 10)), k), a AS (PARTITION BY f)),
best AS (SELECT * FROM sums WHERE least(nl, nt - nl) >= 20
         ORDER BY round(gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1), 9) DESC, f, nl LIMIT 1),
lefts AS (SELECT s.v FROM sums s, best b WHERE s.f = b.f AND s.nl <= b.nl),
placed AS (SELECT t.*, CASE (SELECT f FROM best) {test} END IN (SELECT v FROM lefts) AS goes_left FROM ranked t),
outcome AS (SELECT t.*, 1 / (1 + exp(-(ln(p / (1 - p)) - 0.5 * CASE WHEN goes_left THEN gl / (hl + 1)
                   ELSE (gt - gl) / (ht - hl + 1) END))) AS p_positive FROM placed t, base, best)"""


sql("boosted_first_tree", with_features("""
SELECT floor(p_positive * 100000000.0 + 0.5) / 100000000.0 AS p_positive, count(*) AS n_rows, CAST(sum(Risk) AS BIGINT) AS n_positive
FROM outcome WHERE rn > (2 * tot + 5) // 10 GROUP BY 1""", _first_split(["Age"])))
sql("boosted_score", with_features("""
SELECT CustomerId, p_positive, CAST(p_positive > 0.5 AS INT) AS prediction,
       CASE WHEN p_positive > 0.5 THEN 'bad' ELSE 'good' END AS "Credit risk prediction"
FROM outcome WHERE rn <= (2 * tot + 5) // 10""", _first_split([])))


# Presentation rounding of double outputs (same as the Spark side).
ROUNDED = {
    "profile_columns": ["mean", "stddev", "min", "p25", "p50", "p75", "max"],
    "scaler_stats": ["mean", "std"],
    "standard_scale": NUMERICAL,
    "log_loss": ["log_loss"],
    "cv_mean_score": ["mean_score"],
    "best_trial": ["mean_score"],
    "best_run": ["precision_recall_score"],
    "linear_score": ["p_positive"],
    "stream_score": ["p_positive"],
    "average_precision": ["average_precision"],
    "roc_auc": ["roc_auc"],
    "pr_auc": ["pr_auc"],
    "promotion_gate": ["challenger_value", "champion_value"],
    "toxic_length_metrics": ["average_precision", "roc_auc", "pr_auc"],
    "merged_profile": ["mean", "stddev", "min", "max"],
    "tune_trials": ["learning_rate", "subsample", "reg_lambda"],
    "assembled_features": ["value"],
    "boosted_first_tree": ["p_positive"],
    "boosted_score": ["p_positive"],
}
for _name, _cols in ROUNDED.items():
    ORACLE[_name] = ("SELECT * REPLACE (" + ", ".join(f"floor({c} * 100000000.0 + 0.5) / 100000000.0 AS {c}"
                                                      for c in _cols)
                     + f") FROM ({ORACLE[_name]})")
