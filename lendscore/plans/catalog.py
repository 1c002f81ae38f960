"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (through the ``applications`` view or
directly) over whole tables; nothing is capped or sampled unless sampling is
the operator itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CREDIT_RULES, UNKNOWN_ACCOUNT, credit_settings
from ..functions import columns as C
from ..operators import clean, features, metrics, models, profile, profile_state, registry, split
from ..session import materialize, scratch_path
from ..sources import changes, files, tables
from ..sources.applications import applications, read_table
from ..streaming import scoring

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Doubles that come from sums (means, std, AP, log loss) or from exp/ln depend
# in their last bits on summation order, which varies with partitioning (and
# differs between engines).  Queries marked ``rounded`` present doubles at
# this many decimals; the operators themselves keep full precision.
PRESENTED_DECIMALS = 8


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def present(col):
    """Round half up to :data:`PRESENTED_DECIMALS` with plain IEEE arithmetic
    (``floor(x * 10^d + 0.5) / 10^d``), which every engine evaluates to the
    same bits -- unlike ``round``, whose tie rules differ between engines."""
    scale = float(10 ** PRESENTED_DECIMALS)
    return (F.floor(col * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def rounded(fn):
    """Register ``fn`` with its double columns rounded for presentation."""
    def wrapper(spark, sf_dir):
        df = fn(spark, sf_dir)
        return df.select(*[present(F.col(f"`{f.name}`")).alias(f.name)
                           if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
                           for f in df.schema.fields])
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = wrapper
    return fn


def raw_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw view with normalised headers (C1), before any cleaning."""
    return C.normalize_column_names(applications(spark, sf_dir))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.feature_table(applications(spark, sf_dir), CREDIT_RULES)


SETTINGS = credit_settings()


# --- 2.2 cleaning and encoding -------------------------------------------
@query
def feature_table(spark, sf_dir):
    return feature_rows(spark, sf_dir)


@query
def normalize_columns(spark, sf_dir):
    return raw_apps(spark, sf_dir)


@query
def nullify_tokens(spark, sf_dir):
    return clean.nullify_tokens(raw_apps(spark, sf_dir), ["Saving_accounts", "Checking_account"], ["NA"])


@query
def collapse_categories(spark, sf_dir):
    return clean.collapse_categories(raw_apps(spark, sf_dir), {
        "Saving_accounts": {"quite rich": "rich"},
        "Housing": {"free": "non-own", "rent": "non-own"},
        "Purpose": {"domestic appliances": "other", "repairs": "other", "vacation/others": "other"},
    })


@query
def fill_missing(spark, sf_dir):
    df = clean.nullify_tokens(raw_apps(spark, sf_dir), ["Saving_accounts", "Checking_account"], ["NA"])
    return clean.fill_missing(df, UNKNOWN_ACCOUNT, ["Saving_accounts", "Checking_account"])


@query
def map_values(spark, sf_dir):
    return clean.map_values(raw_apps(spark, sf_dir), {"good": "0", "bad": "1"}, ["Risk"])


@query
def ordinal_encode(spark, sf_dir):
    df = clean.fill_missing(
        clean.nullify_tokens(raw_apps(spark, sf_dir), ["Saving_accounts", "Checking_account"], ["NA"]),
        UNKNOWN_ACCOUNT, ["Saving_accounts", "Checking_account"])
    df = clean.collapse_categories(df, {"Saving_accounts": {"quite rich": "rich"}})
    sav, chk = (e.mapping for e in CREDIT_RULES.encodings[:2])
    return clean.ordinal_encode(df, ["Saving_accounts", "Checking_account"], [sav, chk],
                                ["Saving_accounts_ordinal_enc", "Checking_account_ordinal_enc"])


@query
def label_encode(spark, sf_dir):
    return clean.label_encode(raw_apps(spark, sf_dir), "Risk", CREDIT_RULES.encodings[2].mapping)


@query
def select_features(spark, sf_dir):
    s = SETTINGS
    return clean.select_features(feature_rows(spark, sf_dir), s.numerical_features,
                                 s.categorical_features, s.target, keys=s.primary_keys)


@query
def nan_to_null(spark, sf_dir):
    df = feature_rows(spark, sf_dir).select(
        "CustomerId",
        F.when(F.col("Job") == 0, F.lit(float("nan"))).otherwise(F.col("Credit_amount"))
         .alias("Credit_amount"))
    return clean.nan_to_null(df)


@query
def decode_label(spark, sf_dir):
    df = feature_rows(spark, sf_dir).select("CustomerId", "Risk")
    return clean.decode_prediction(df, "Risk", "Risk_label")


@query
def preview(spark, sf_dir):
    return clean.preview(feature_rows(spark, sf_dir), 10, order_by=["CustomerId"])


# --- 2.5 splits and sampling ---------------------------------------------
def split_feature_rows(spark, sf_dir):
    return split_columns(spark, sf_dir, None)


def split_columns(spark, sf_dir, columns):
    """The split of the feature table, or of the ``columns`` that a query uses beside
    key and target: the others are pruned before the table is stored."""
    s = SETTINGS
    # The split reads the stored feature table, as the training job does
    # (the extract job writes it once); its counting pass then scans two
    # columns instead of re-running the join.
    rows = feature_rows(spark, sf_dir)
    if columns is not None:
        rows = rows.select(*dict.fromkeys([*s.primary_keys, s.target, *columns]))
    stored = materialize(rows, "feature-table")
    return split.stratified_split(stored, s.primary_keys, s.target,
                                  s.test_fraction, s.n_folds, s.seed)


@query
def stratified_split(spark, sf_dir):
    return split_columns(spark, sf_dir, []).select("CustomerId", "Risk", "is_test")


@query
def stratified_folds(spark, sf_dir):
    return split_feature_rows(spark, sf_dir).select("CustomerId", "fold")


@query
def sample_n_replace(spark, sf_dir):
    s = SETTINGS
    df = clean.select_features(feature_rows(spark, sf_dir), s.numerical_features,
                               s.categorical_features, keys=s.primary_keys)
    return split.sample_with_replacement(df, 100, "CustomerId", seed=s.seed)


# --- 2.3 profiling and aggregation ---------------------------------------
PROFILE_COLS = ["Credit_amount", "Duration", "Age", "Sex", "Job", "Housing", "Purpose",
                "Saving_accounts", "Checking_account", "Saving_accounts_ordinal_enc",
                "Checking_account_ordinal_enc", "Risk"]
CATEGORY_COLS = ["Sex", "Job", "Housing", "Purpose", "Saving_accounts", "Checking_account"]


@rounded
def profile_columns(spark, sf_dir):
    """A1: exact profile, with a column that has no value at all."""
    rows = feature_rows(spark, sf_dir).withColumn("Nothing", F.lit(None).cast("double"))
    return profile.profile_columns(rows, [*PROFILE_COLS, "Nothing"], exact=True)


@rounded
def merged_profile(spark, sf_dir):
    """States of parts of the table (one per job class), stored and combined: the exact moments."""
    rows = feature_rows(spark, sf_dir).withColumn("Amount", F.when(F.col("CustomerId") % 7 != 0, F.col("Credit_amount")))
    path = scratch_path(spark, "states")
    for k in range(4):
        profile_state.profile_state(rows.filter(F.col("Job") == k), MERGED_COLS).write.mode("append").parquet(path)
    merged = profile_state.merge_states(spark.read.parquet(path))
    return profile_state.finished(merged).select("column_name", "n_rows", "n_null", "mean", "stddev", "min", "max")


MERGED_COLS = ["Amount", "Duration", "Age", "Sex"]


@query
def profile_sketch(spark, sf_dir):
    """A1 in its default mode: one pass, bounded-memory sketches
    (approx_count_distinct, percentile_approx); rows-only (approximate)."""
    return profile.profile_columns(feature_rows(spark, sf_dir), PROFILE_COLS)


@query
def cardinality_plan(spark, sf_dir):
    return profile.cardinality_plan(feature_rows(spark, sf_dir), SETTINGS.categorical_features)


@query
def target_rate(spark, sf_dir):
    return profile.target_rate(feature_rows(spark, sf_dir), CATEGORY_COLS, "Risk")


@query
def category_share(spark, sf_dir):
    return profile.category_share(feature_rows(spark, sf_dir), CATEGORY_COLS)


@query
def derive_ordinal(spark, sf_dir):
    return profile.derive_ordinal(feature_rows(spark, sf_dir), ["Saving_accounts", "Checking_account"], "Risk")


# --- 2.3 / 2.6 dictionaries, scaler and encoders (fit on train, apply to test)
def split_tables(spark, sf_dir, columns=None):
    """Train and test rows of one split, written once to the shared checkpoint
    folder (the way a job persists its split) so fit and transform both read
    it instead of re-ranking."""
    s = materialize(split_columns(spark, sf_dir, columns), "split")
    return s.filter(~F.col("is_test")), s.filter(F.col("is_test"))


def train_rows(spark, sf_dir, columns=None):
    return split_columns(spark, sf_dir, columns).filter(~F.col("is_test"))


@query
def category_dictionary(spark, sf_dir):
    return features.dictionary_frame(train_rows(spark, sf_dir, SETTINGS.categorical_features),
                                     SETTINGS.categorical_features)


@query
def dictionary_exact(spark, sf_dir):
    """Codes of whole numbers beyond 2^53 of both signs, and of decimals of more digits than a double has."""
    big = F.lit(9007199254740990) + F.col("o_orderkey")
    orders = read_table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 2 == 1, -big).otherwise(big).alias("big"),
        (F.lit("100000000000000000000.00").cast("decimal(30,2)") + F.col("o_custkey").cast("decimal(18,2)"))
        .cast("decimal(38,2)").alias("dec"))
    return features.dictionary_frame(orders, ["big", "dec"])


@rounded
def scaler_stats(spark, sf_dir):
    return features.scaler_stats(train_rows(spark, sf_dir, SETTINGS.numerical_features),
                                 SETTINGS.numerical_features)


@rounded
def standard_scale(spark, sf_dir):
    nums = SETTINGS.numerical_features
    train, test = split_tables(spark, sf_dir, nums)
    m = features.PopulationStandardScaler(inputCols=nums).fit(train)
    return m.transform(test).select("CustomerId", *nums)


ONE_HOT_COLS = ["Job", "Purpose", "Saving_accounts_ordinal_enc", "Checking_account_ordinal_enc"]
BINARY_COLS = ["Sex", "Housing"]


@query
def one_hot(spark, sf_dir):
    train, test = split_tables(spark, sf_dir, ONE_HOT_COLS)
    m = features.OneHotColumns(inputCols=ONE_HOT_COLS).fit(train)
    return m.transform(test).select("CustomerId", *m.output_names())


@query
def one_hot_many(spark, sf_dir):
    """F2 over a column of many categories (order keys of the line items), as sparse slots."""
    items = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    m = features.CategoryCodes(inputCols=["l_orderkey"], outputCols=["code"]).fit(items.filter("l_linenumber = 1"))
    return features.one_hot_slots(items, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], m)


@query
def composite_split(spark, sf_dir):
    """S1 / S2 on a composite key: line items stratified by return flag."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    items = read_table(spark, sf_dir, "lineitem").select(*keys, "l_returnflag")
    return split.stratified_split(items, keys, "l_returnflag", "0.2", 5, 42)


@query
def schema_check(spark, sf_dir):
    """The signature's columns, widened one way, beside the key."""
    from .jobs import capture_schema, check_schema
    rows = feature_rows(spark, sf_dir)
    wide = rows.select(F.col("Age").cast("bigint"), F.col("Credit_amount"), F.col("Job").cast("double"))
    return check_schema(rows, capture_schema(wide, wide.columns), keep=["CustomerId"])


@query
def registry_versions(spark, sf_dir):
    """One version per order priority, registered in the order of its name, with the customers' number as tag."""
    root = scratch_path(spark, "registry")
    names = [r[0] for r in read_table(spark, sf_dir, "orders").groupBy("o_orderpriority").count()
             .orderBy("o_orderpriority").collect()]
    for name in names:  # five values: a registry entry each
        registry.register_version(spark, root, "model", f"models/{name}", name, tags={"priority": name})
    return registry.read_versions(spark, root).select("model_name", "version", "path", "run_id",
                                                      F.col("tags")["priority"].alias("priority"))


@query
def binary_encode(spark, sf_dir):
    train, test = split_tables(spark, sf_dir, BINARY_COLS)
    m = features.BinaryOrdinal(inputCols=BINARY_COLS,
                               outputCols=[f"{c}_bin" for c in BINARY_COLS]).fit(train)
    return m.transform(test).select("CustomerId", *[f"{c}_bin" for c in BINARY_COLS])


@query
def category_codes(spark, sf_dir):
    cats = SETTINGS.categorical_features
    train, test = split_tables(spark, sf_dir, cats)
    m = features.CategoryCodes(inputCols=cats, outputCols=[f"{c}_code" for c in cats]).fit(train)
    return m.transform(test).select("CustomerId", *[f"{c}_code" for c in cats])


# --- 2.7 metrics on deterministic evaluation scores --------------------------
# Two fixed scorers of the applications (hash noise + label signal, with ties):
# "challenger" and "champion".  Everything downstream is the real operator.
def _noise(seed: int):
    return C.hex_prefix_int(C.keyed_md5(F.col("CustomerId"), seed), 3)


def with_eval_scores(df):
    risk = F.col("Risk")
    return df.select(
        "CustomerId", "Risk", "fold", "is_test",
        ((_noise(1) + risk * 1500) / F.lit(5595.0)).alias("score_challenger"),
        ((_noise(2) + risk * 800) / F.lit(4895.0)).alias("score_champion"))


def scored_test(spark, sf_dir):
    return with_eval_scores(split_columns(spark, sf_dir, [])).filter("is_test")


@rounded
def average_precision(spark, sf_dir):
    return metrics.average_precision(scored_test(spark, sf_dir), "Risk", "score_challenger")


@rounded
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(scored_test(spark, sf_dir), "Risk", "score_challenger")


@rounded
def pr_auc(spark, sf_dir):
    return metrics.pr_auc(scored_test(spark, sf_dir), "Risk", "score_challenger")


@query
def confusion_metrics(spark, sf_dir):
    return metrics.confusion_metrics(scored_test(spark, sf_dir), "Risk", score="score_challenger")


@rounded
def log_loss(spark, sf_dir):
    return metrics.log_loss(scored_test(spark, sf_dir), "Risk", "score_challenger")


@rounded
def promotion_gate(spark, sf_dir):
    return metrics.promotion_gate(scored_test(spark, sf_dir), "Risk", "score_challenger",
                                  "score_champion")


# Trial family for the tuning-result queries: trial t scores with its own
# noise seed and label weight; cross-validated on the training folds.
TRIAL_WEIGHTS = (300, 800, 1500, 2500)


def trial_fold_scores(spark, sf_dir):
    train = split_feature_rows(spark, sf_dir).filter(~F.col("is_test"))
    items = [F.struct(F.lit(t).alias("trial"),
                      ((_noise(10 + t) + F.col("Risk") * w) / F.lit(4095.0 + w)).alias("score"))
             for t, w in enumerate(TRIAL_WEIGHTS)]
    long = train.select("Risk", "fold", F.explode(F.array(*items)).alias("_t")).select(
        "_t.trial", "fold", "Risk", "_t.score")
    return metrics.average_precision(long, "Risk", "score", by=["trial", "fold"])


@rounded
def cv_mean_score(spark, sf_dir):
    return registry.cv_mean(trial_fold_scores(spark, sf_dir), "trial", "average_precision")


@rounded
def best_trial(spark, sf_dir):
    cv = registry.cv_mean(trial_fold_scores(spark, sf_dir), "trial", "average_precision")
    return registry.best_trial(cv, "trial", "mean_score")


@query
def latest_version(spark, sf_dir):
    """K2: trials gated in order against the current champion; the alias
    points at the newest promoted version."""
    cv = registry.cv_mean(trial_fold_scores(spark, sf_dir), "trial", "average_precision")
    versions = registry.promotion_sequence(cv, "trial", "mean_score", SETTINGS.model_name)
    return registry.latest_version(versions, SETTINGS.model_name)


@rounded
def best_run(spark, sf_dir):
    runs = registry.runs_from_trials(trial_fold_scores(spark, sf_dir), "trial", "fold",
                                     "average_precision", study="hyperparameter_tuning_")
    return registry.best_run(runs, "hyperparameter_tuning_%", "precision_recall_score")


# --- 2.6 / 2.7 pipelines, training, tuning and scoring -----------------------
def _evaluate(model, test):
    # score the test rows once (three narrow columns), then evaluate
    scored = materialize(models.score(model, test, ["CustomerId"], extra=["Risk"]), "scored")
    return metrics.classifier_metrics(scored, "Risk", models.P1)


@query
def train_baseline(spark, sf_dir):
    """J3 core: fit the logistic baseline on train, metrics on test (1 row)."""
    train, test = split_tables(spark, sf_dir)
    return _evaluate(models.fit(train, SETTINGS, "baseline"), test)


@query
def train_boosted(spark, sf_dir):
    """J4 core: fit boosted trees with the configured parameters; test metrics."""
    train, test = split_tables(spark, sf_dir)
    return _evaluate(models.fit(train, SETTINGS, "boosted"), test)


@rounded
def tune_trials(spark, sf_dir):
    """M3: the whole study of ``models.tune`` (100 trials x 5 stratified folds, 100-500 trees): each trial's
    parameters and whether its mean score is a possible average precision."""
    trials, scores = models.tune(train_rows(spark, sf_dir), SETTINGS)
    rows = [(i, t["n_estimators"], t["learning_rate"], t["num_leaves"], t["subsample"], t["reg_lambda"], 0.0 < s <= 1.0)
            for i, (t, s) in enumerate(zip(trials, scores))]
    return spark.createDataFrame(rows, "trial int, n_estimators int, learning_rate double, num_leaves int, "
                                       "subsample double, reg_lambda double, scored boolean")


@query
def baseline_optimality(spark, sf_dir):
    """M1: the fitted baseline is optimal, by its gradient and its duality gap."""
    train, _ = split_tables(spark, sf_dir)
    found = models.optimality(models.fit(train, SETTINGS, "baseline"), train, SETTINGS)
    return found.select("n_rows", (F.col("max_gradient") < 1e-4).alias("gradient_vanishes"),
                        F.col("relative_gap").between(-1e-9, 1e-3).alias("gap_closes"))


@rounded
def assembled_features(spark, sf_dir):
    """the features vector of the test rows (scaled numbers, then codes), by slot."""
    train, test = split_tables(spark, sf_dir, SETTINGS.model_features)
    s = SETTINGS
    m = models.FeatureAssembler(numerical=s.numerical_features, categorical=s.categorical_features, mode="codes").fit(train)
    return m.transform(test).select("CustomerId", F.posexplode(vector_to_array(models.FEATURES)).alias("slot", "value"))


#: One split of a tree, small enough to be found in SQL too: its features and parameters.
FIRST_TREE = {"n_estimators": 1, "learning_rate": 0.5, "num_leaves": 2, "reg_lambda": 1.0}
FIRST_TREE_CATEGORIES = ["Job", "Purpose", "Saving_accounts_ordinal_enc", "Checking_account_ordinal_enc"]


def _first_tree(spark, sf_dir, numbers):
    train, test = split_tables(spark, sf_dir)
    settings = replace(SETTINGS, numerical_features=numbers, categorical_features=FIRST_TREE_CATEGORIES, hyperparameters=FIRST_TREE)
    return models.fit(train, settings, "boosted"), train, test


@rounded
def boosted_first_tree(spark, sf_dir):
    """M2: the best split and L2 leaf values over a number and nominal codes, as scores of the training rows."""
    model, train, _ = _first_tree(spark, sf_dir, ["Age"])
    scored = materialize(models.score(model, train, ["CustomerId"], extra=["Risk"]), "scored")
    return scored.groupBy(present(F.col(models.P1)).alias(models.P1)).agg(
        F.count("*").alias("n_rows"), F.sum("Risk").cast("bigint").alias("n_positive"))


@rounded
def boosted_score(spark, sf_dir):
    """A pipeline whose tree splits codes into two sets, applied to the test rows."""
    model, _, test = _first_tree(spark, sf_dir, [])
    return models.score(model, test, ["CustomerId"], label_text="Credit risk prediction")


@query
def batch_score(spark, sf_dir):
    """Baseline model scores every test row; class decoded to text."""
    train, test = split_tables(spark, sf_dir)
    m = models.fit(train, SETTINGS, "baseline")
    return models.score(m, test, ["CustomerId"], label_text="Credit risk prediction")


# Fixed-coefficient scorer (reproducible in SQL) over the feature table.
LINEAR_WEIGHTS = {"Credit_amount": 0.00001, "Duration": 0.02, "Age": -0.01,
                  "Saving_accounts_ordinal_enc": -0.15, "Checking_account_ordinal_enc": 0.1}
LINEAR_INTERCEPT = -0.5


def linear_scorer():
    import json
    return models.LinearScorer(weights=json.dumps(LINEAR_WEIGHTS), intercept=LINEAR_INTERCEPT)


@rounded
def linear_score(spark, sf_dir):
    out = linear_scorer().transform(feature_rows(spark, sf_dir))
    return clean.decode_prediction(out.select("CustomerId", models.P1, "prediction"),
                                   "prediction", "Credit risk prediction")


# --- 2.7 M11 streaming scoring ---------------------------------------------------
@rounded
def stream_score(spark, sf_dir):
    """Feature rows land as files; a stream scores them with the fixed linear
    scorer (exactly one output per input) into a parquet sink."""
    base = scratch_path(spark, "stream")
    feats = feature_rows(spark, sf_dir)
    feats.write.mode("overwrite").parquet(f"{base}/in")
    out = scoring.run_available_now(spark, f"{base}/in", feats.schema, linear_scorer(), ["CustomerId"],
                                    models.P1, f"{base}/out", f"{base}/checkpoint",
                                    max_files_per_trigger=2)
    return out


# --- 2.1 sources and sinks ---------------------------------------------------------
@query
def csv_roundtrip(spark, sf_dir):
    """Raw applications written as CSV, read back with the pandas null
    tokens (``NA`` and empty become null) and an explicit schema; ``Note`` has quotes
    and line ends, padded values and tokens."""
    note = (F.when(F.col("CustomerId") % 3 == 0, 'said "yes, please",\nthen left')
            .when(F.col("CustomerId") % 3 == 1, "  padded ").otherwise("NA"))
    raw = applications(spark, sf_dir).withColumn("Note", note)
    path = scratch_path(spark, "csv")
    (raw.write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
    back = files.read_csv(spark, path, schema=raw.schema)
    return C.normalize_column_names(back)


@query
def feature_table_roundtrip(spark, sf_dir):
    """I4: the feature table overwritten (schema replaced) and read back."""
    path = scratch_path(spark, "features")
    tables.overwrite_table(feature_rows(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def key_violations(spark, sf_dir):
    """NOT NULL + primary-key checks on the feature table (clean) and on
    lineitem keyed by order alone (duplicates expected)."""
    f = tables.key_violations(feature_rows(spark, sf_dir), ["CustomerId"])
    li = tables.key_violations(read_table(spark, sf_dir, "lineitem"), ["l_orderkey"])
    return (f.withColumn("table_name", F.lit("features"))
            .unionByName(li.withColumn("table_name", F.lit("lineitem"))))


@query
def latest_snapshot(spark, sf_dir):
    """Two snapshots; the second keeps Job < 3, adds a column and makes Job
    text.  The latest is read back with its own schema."""
    path = scratch_path(spark, "snapshots")
    feats = feature_rows(spark, sf_dir)
    tables.write_snapshot(feats, path)
    changed = (feats.filter(F.col("Job") < 3).withColumn("Job", F.col("Job").cast("string"))
               .withColumn("Adult_years", F.col("Age") - 18))
    tables.write_snapshot(changed, path, keys=SETTINGS.primary_keys)
    return tables.read_snapshot(spark, path)


def _two_snapshots(spark, sf_dir):
    """Orders, then orders without some, with others changed and new ones."""
    path = scratch_path(spark, "snapshots")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    later = orders.filter(key % 50 != 0).withColumn(
        "o_totalprice", F.when(key % 49 == 1, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")))
    later = later.unionByName(orders.filter(key % 51 == 0).withColumn("o_orderkey", key + 1_000_000_000))
    for operation, rows in (("create", orders), ("update", later)):
        snapshot = tables.write_snapshot(rows, path, keys=["o_orderkey"])
        changes.record(spark, path, snapshot, operation)
        changes.index_snapshot(spark, path, snapshot, ["o_orderkey"])
    return path


@query
def snapshot_diff(spark, sf_dir):
    """Keys added, removed and changed between two snapshots, by their digest trees."""
    return changes.changed_keys(spark, _two_snapshots(spark, sf_dir), 0, 1, ["o_orderkey"])


@query
def snapshot_history(spark, sf_dir):
    """The recorded snapshots."""
    return changes.history(spark, _two_snapshots(spark, sf_dir)).select("snapshot_id", "operation", "n_rows")


@query
def dataset_lineage(spark, sf_dir):
    """Rows and content digest of the train and test sets of one run."""
    s = split_feature_rows(spark, sf_dir)
    train = s.filter(~F.col("is_test")).drop("is_test", "fold")
    test = s.filter(F.col("is_test")).drop("is_test", "fold")
    return tables.dataset_lineage([("credit_features", train, "training", 0),
                                   ("credit_features", test, "testing", 0)], run_id="run-0")


@query
def to_json_records(spark, sf_dir):
    """I8: feature rows as JSON records, NaN/null kept as JSON null."""
    s = SETTINGS
    return files.to_json_records(feature_rows(spark, sf_dir), s.model_features)


# --- the same operators on a second, imbalanced dataset ----------------------------
# labels (quality, toxic) joined to documents (lang, source, n_chars): the
# operators are column-generic; only the column names change.
def labelled_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return read_table(spark, sf_dir, "labels").join(docs, "doc_id")


@query
def quality_split(spark, sf_dir):
    return split.stratified_split(labelled_documents(spark, sf_dir), "doc_id", "quality") \
        .select("doc_id", "quality", "is_test", "fold")


@query
def quality_target_rate(spark, sf_dir):
    return profile.target_rate(labelled_documents(spark, sf_dir), ["lang", "source"], "quality")


@rounded
def toxic_length_metrics(spark, sf_dir):
    """How well document length alone ranks toxic documents."""
    d = labelled_documents(spark, sf_dir).withColumn("score", F.col("n_chars").cast("double"))
    return metrics.ranking_metrics(d, "toxic", "score")
