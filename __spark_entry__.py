"""Queries for the driver: one per operator, each with SQL for the cross-check where SQL can say it.

``queries()`` reads the given tables whole. Source and sink queries write what they derive
from them under a new folder inside ``spark.checkpoint.dir`` and read it back.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom import sources
from loanloom.functions import binary_label, hash_bucket, parse_failed, split_item, unit_value
from loanloom.operators import aggregates, evaluation, features, inspection, models, stratified, tree_rules
from loanloom.operators.cleaning import parse_units
from loanloom.operators.filters import where_equal, where_not_equal
from loanloom.operators.flow_stages import raw_flow
from loanloom.plans import loans as plan
from loanloom.plans.fixture import loans, pack_csv_archives, table
from loanloom.plans.statements import register, run_sql
from loanloom.session import materialize, scratch_dir
from loanloom.sources.inference import inferred_types as infer_types
from loanloom.streaming.arrivals import append_to_table, csv_arrivals
from loanloom.streaming.counts import current_counts, keep_counts
from oracles import ORACLES

KEY = ("loan_id",)


def entry(spark: SparkSession) -> DataFrame:
    """Loans with collections by state, from raw loans to the grouped count."""
    return loans_by_state(spark, "/root/testdata/sf0.001")


def cleaned(spark, sf):
    return plan.clean(loans(spark, sf), keep=KEY)


def feature_rows(spark, sf):
    return plan.features(cleaned(spark, sf))


def stored_features(spark, sf):
    """Feature rows written once: every job of a fit then reads columns, not the joins."""
    return materialize(feature_rows(spark, sf), "features")


# --- cleaning -------------------------------------------------------------------------


def loans_by_state(spark, sf):
    return plan.collections_by_state(cleaned(spark, sf))


def loan_columns(spark, sf):
    return plan.working_columns(loans(spark, sf))


def etl_term(spark, sf):
    return plan.clean_term(loans(spark, sf), keep=KEY)


def etl_keep_source(spark, sf):
    working = plan.working_columns(loans(spark, sf), keep=KEY)
    return parse_units(working, plan.UNIT_RULES, keep=["revol_util"])


def parse_failures(spark, sf):
    return plan.unreadable_units(loans(spark, sf))


def unreadable_terms(spark, sf):
    rows = loans(spark, sf)
    value = plan.TERM_RULE.column()
    return rows.where(parse_failed("term", value)).select("loan_id", "term")


def priority_number(spark, sf):
    number = unit_value("o_orderpriority", "-", 0, "int")
    text = split_item("o_orderpriority", "-", 1)
    return table(spark, sf, "orders").select(
        "o_orderkey", number.alias("priority_no"), text.alias("priority_text")
    )


def brand_number(spark, sf):
    number = unit_value("p_brand", "#", 1, "int").alias("brand_no")
    return table(spark, sf, "part").select("p_partkey", number)


def customer_number(spark, sf):
    number = unit_value("c_name", "#", 1, "int").alias("customer_no")
    return table(spark, sf, "customer").select("c_custkey", number)


# --- filters, counts, inspection --------------------------------------------------------


def count_all(spark, sf):
    return aggregates.row_count(loans(spark, sf))


def collections_rows(spark, sf):
    return plan.with_collections(cleaned(spark, sf))


def count_collections(spark, sf):
    return aggregates.row_count(collections_rows(spark, sf))


def collections_text_filter(spark, sf):
    as_text = F.col(plan.COLLECTIONS).cast("string")
    rows = loans(spark, sf).withColumn(plan.COLLECTIONS, as_text)
    return where_not_equal(rows, plan.COLLECTIONS, 0).select("loan_id", plan.COLLECTIONS)


def status_counts(spark, sf):
    return aggregates.group_count(table(spark, sf, "orders"), "o_orderstatus")


def state_grade_counts(spark, sf):
    return aggregates.group_count(loans(spark, sf), plan.STATE, "grade")


def describe_schema(spark, sf):
    register(loans(spark, sf), "described_loans")
    return inspection.describe(spark, "described_loans").withColumn(
        "comment", F.coalesce("comment", F.lit(""))
    )


def numeric_columns(spark, sf):
    rows = loans(spark, sf)
    return sources.required_nulls(rows, inspection.numeric_columns(rows))


def non_numeric_columns(spark, sf):
    rows = loans(spark, sf)
    return sources.required_nulls(rows, inspection.non_numeric_columns(rows))


def preview(spark, sf):
    return inspection.preview(loans(spark, sf))


def first_row(spark, sf):
    ordered = table(spark, sf, "orders").orderBy("o_orderkey")
    first = [inspection.first_value(ordered, c) for c in ("o_orderkey", "o_orderpriority")]
    return spark.createDataFrame([tuple(first)], "o_orderkey long, o_orderpriority string")


def user_stamp(spark, sf):
    stamped = loans(spark, sf).withColumn("loaded_by", F.current_user())
    return stamped.agg(
        F.count(F.lit(1)).alias("loan_rows"), F.count("loaded_by").alias("stamped_rows")
    )


# --- SQL --------------------------------------------------------------------------------


def sql_etl(spark, sf):
    return plan.clean_sql(loans(spark, sf), keep=KEY)


def sql_collections_by_state(spark, sf):
    return plan.collections_by_state_sql(cleaned(spark, sf))


def sql_view_chain(spark, sf):
    register(cleaned(spark, sf), "chain_loans")
    register(
        run_sql(
            spark,
            "select * from chain_loans where collections_12_mths_ex_med <> :none",
            args={"none": 0},
        ),
        "chain_collections",
    )
    run_sql(
        spark,
        "create or replace temporary view chain_grades as "
        "select grade, count(*) as count from chain_collections group by grade",
    )
    return run_sql(spark, "select * from chain_grades")


def sql_join(spark, sf):
    return run_sql(
        spark,
        """
        select n_name, count(*) as orders, max(o_totalprice) as largest
        from {orders} join {customer} on o_custkey = c_custkey
                      join {nation} on c_nationkey = n_nationkey
        where o_orderstatus = :status
        group by n_name having count(*) > 1
        """,
        args={"status": "F"},
        orders=table(spark, sf, "orders"),
        customer=table(spark, sf, "customer"),
        nation=table(spark, sf, "nation"),
    )


def sql_window(spark, sf):
    return run_sql(
        spark,
        """
        select o_custkey, o_orderkey,
               cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey)
                    as bigint) as order_no,
               max(o_totalprice) over (partition by o_custkey) as largest
        from {orders}
        """,
        orders=table(spark, sf, "orders"),
    )


def sql_sort_limit(spark, sf):
    return run_sql(
        spark,
        """
        select o_orderkey, o_totalprice from {orders}
        order by o_totalprice desc, o_orderkey limit 25
        """,
        orders=table(spark, sf, "orders"),
    )


def sql_set_op(spark, sf):
    return run_sql(
        spark,
        """
        select c_custkey as custkey from {customer}
        except
        select o_custkey from {orders} where o_orderstatus = 'F'
        """,
        customer=table(spark, sf, "customer"),
        orders=table(spark, sf, "orders"),
    )


# --- sources and sinks ------------------------------------------------------------------


def as_loans(df, spark, sf):
    """Columns in the types of the loan table; inference narrows some of them."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in loans(spark, sf).schema])


def csv_folder(spark, sf):
    path = scratch_dir(spark, "csv")
    sources.write_csv(loans(spark, sf), path)
    return path


def csv_roundtrip(spark, sf):
    return as_loans(sources.read_csv(spark, csv_folder(spark, sf)), spark, sf)


def csv_schema_roundtrip(spark, sf):
    path = scratch_dir(spark, "csv")
    rows = loans(spark, sf)
    sources.write_csv(rows, path, sep="|")
    return sources.read_csv(spark, path, schema=rows.schema, sep="|")


def csv_sql_view(spark, sf):
    view = sources.csv_view(spark, "csv_loans", csv_folder(spark, sf))
    return as_loans(view, spark, sf)


def csv_corrupt_rows(spark, sf):
    # orders as text, read with a numeric type for the priority: no row may be lost
    path = scratch_dir(spark, "csv")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    sources.write_csv(orders, path)
    wrong = orders.withColumn("o_orderpriority", F.lit(0)).schema
    read = sources.read_csv(spark, path, schema=wrong, corrupt_column="raw_line")
    return read.select("o_orderkey", "o_orderpriority", "raw_line")


def table_folder(spark, sf, **options):
    path = scratch_dir(spark, "table")
    sources.write_table(cleaned(spark, sf), path, **options)
    return path


def table_roundtrip(spark, sf):
    return sources.read_table(spark, table_folder(spark, sf))


def table_replaced(spark, sf):
    path = table_folder(spark, sf)
    sources.write_table(collections_rows(spark, sf), path)
    return sources.read_table(spark, path)


def table_sql_view(spark, sf):
    return sources.table_view(spark, "table_loans", table_folder(spark, sf))


def partitioned_folder(spark, sf):
    path = scratch_dir(spark, "partitioned")
    rows = sources.spread(cleaned(spark, sf), plan.STATE)
    sources.write_table(rows, path, partition_by=[plan.STATE])
    return path, rows.schema


def partitioned_roundtrip(spark, sf):
    path, schema = partitioned_folder(spark, sf)
    return sources.read_table(spark, path, schema=schema)


def partition_filter(spark, sf):
    path, schema = partitioned_folder(spark, sf)
    return where_equal(sources.read_table(spark, path, schema=schema), plan.STATE, "NATION_7")


def repartition_rows(spark, sf):
    spread = sources.spread(cleaned(spark, sf), plan.STATE)
    return aggregates.group_count(spread, plan.STATE)


def repartition_salted(spark, sf):
    return sources.spread(cleaned(spark, sf), plan.STATE, salt=4)


def new_table(spark, df, name):
    return sources.create_table_as(
        df, "loanloom_queries", name, location=scratch_dir(spark, "database")
    )


def ctas_roundtrip(spark, sf):
    return new_table(spark, cleaned(spark, sf), "ctas_loans")


def ctas_at_path(spark, sf):
    path = scratch_dir(spark, "external")
    sources.create_table_as(
        cleaned(spark, sf), "loanloom_queries", "loans_at_path",
        location=scratch_dir(spark, "database"), path=path,
    )
    return sources.read_table(spark, path)


def insert_overwrite(spark, sf):
    new_table(spark, cleaned(spark, sf), "overwritten_loans")
    rows = collections_rows(spark, sf)
    return sources.insert_overwrite(
        rows.select(*reversed(rows.columns)), "loanloom_queries.overwritten_loans"
    )


def enforced_write(spark, sf):
    rows = cleaned(spark, sf)
    schema = spark.createDataFrame([], rows.schema).schema
    for field in schema:
        field.nullable = field.name not in ("loan_id", "loan_amnt", "addr_state")
    path = scratch_dir(spark, "enforced")
    sources.write_enforced(rows, path, schema)
    return sources.read_table(spark, path)


def required_nulls(spark, sf):
    return sources.required_nulls(cleaned(spark, sf), ["loan_id", "newTerm", "dti"])


def manifest(spark, sf):
    return sources.manifest(spark, sf, glob="*.parquet").select("name", "size")


def zip_landing(spark, sf):
    folder = scratch_dir(spark, "archives")
    rows = loans(spark, sf)
    pack_csv_archives(rows, folder)
    landed = scratch_dir(spark, "landed")
    sources.write_table(sources.read_zipped_csv(spark, folder, rows.schema), landed)
    read = sources.read_table(spark, landed)
    return read.select(*rows.columns, "_corrupt_record")


def stream_etl(spark, sf):
    folder = csv_folder(spark, sf)
    target, checkpoint = scratch_dir(spark, "stream"), scratch_dir(spark, "progress")
    arrivals = csv_arrivals(spark, folder, loans(spark, sf).schema)
    query = append_to_table(
        arrivals, lambda rows: plan.clean(rows, keep=KEY), target, checkpoint
    )
    query.awaitTermination()
    return sources.read_table(spark, target)


def manifest_delta(spark, sf):
    # orders arrive by status in three rounds; a landing reads what is new and nothing else
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    folder, landed = scratch_dir(spark, "arrived"), scratch_dir(spark, "landed")

    def read(paths):
        return spark.read.schema(orders.schema).option("header", True).csv(paths)

    for status in "FOP":
        sources.write_csv(orders.where(F.col("o_orderstatus") == status), f"{folder}/{status}")
        sources.land_new(spark, folder, landed, read, glob="*.csv")
    sources.land_new(spark, folder, landed, read, glob="*.csv")
    return sources.landed_rows(spark, landed).select("o_orderkey", "o_orderstatus", "landing")


def insert_overwrite_partition(spark, sf):
    path, schema = partitioned_folder(spark, sf)
    small = cleaned(spark, sf).where("addr_state in ('NATION_3', 'NATION_7') and loan_amnt < 10000")
    sources.replace_partitions(
        small, path, [plan.STATE], "addr_state in ('NATION_3', 'NATION_7', 'NATION_11')"
    )
    return sources.read_table(spark, path, schema=schema)


def enforced_quarantine(spark, sf):
    rows = cleaned(spark, sf)
    schema = spark.createDataFrame([], rows.schema).schema
    for field in schema:
        field.nullable = field.name not in ("loan_id", "dti", "newTerm")
    path, aside = scratch_dir(spark, "enforced"), scratch_dir(spark, "quarantine")
    sources.write_or_quarantine(rows, path, aside, schema, {"amount above 30000": "loan_amnt <= 30000"})
    good = sources.read_table(spark, path).select("loan_id", "loan_amnt", "dti", F.lit("none").alias("violation"))
    bad = sources.read_quarantine(spark, aside, schema).select("loan_id", "loan_amnt", "dti", "violation")
    return good.unionByName(bad)


def clustered_roundtrip(spark, sf):
    path = scratch_dir(spark, "clustered")
    sources.write_clustered(cleaned(spark, sf), path, [plan.STATE, "loan_amnt"], parts=16)
    return sources.read_table(spark, path)


def bucketed_loans(spark, sf, buckets=8):
    place = scratch_dir(spark, "database")
    rows = loans(spark, sf).select("loan_id", "addr_state")
    payments = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("loan_id"), "l_quantity")
    return [
        sources.create_bucketed_table(df, "loanloom_queries", name, ["loan_id"], buckets, ["loan_id"], location=place)
        for df, name in ((rows, "bucketed_loans"), (payments, "bucketed_payments"))
    ]


def bucketed_join(spark, sf):
    rows, payments = bucketed_loans(spark, sf)
    # small tables would be broadcast; the layout is for those that are not
    return rows.join(payments.hint("merge"), "loan_id").groupBy("loan_id").agg(
        F.max("addr_state").alias("addr_state"), F.count(F.lit(1)).alias("payments"),
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
    )


def inferred_types(spark, sf):
    texts = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_no"),
        F.when(F.col("o_orderkey") % 1000 == 0, "unknown").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        "o_orderstatus",
        F.col("o_orderdate").cast("date").cast("string").alias("ordered"),
        F.when(F.col("o_orderkey") % 7 == 0, " ").otherwise((F.col("o_totalprice") > 100000).cast("string")).alias("large"),
    )
    return infer_types(texts)


def stream_state_counts(spark, sf):
    folder = csv_folder(spark, sf)
    state = scratch_dir(spark, "counts")
    for _ in range(2):  # the second run has forgotten its progress and repeats every batch
        arrivals = csv_arrivals(spark, folder, loans(spark, sf).schema, max_files=1)
        query = keep_counts(
            arrivals, lambda rows: plan.with_collections(plan.clean(rows)), [plan.STATE], state,
            scratch_dir(spark, "progress"), compact_after=3,
        )
        query.awaitTermination()
    return current_counts(spark, state, [plan.STATE])


# --- labels, weights, split -------------------------------------------------------------


def binary_labels(spark, sf):
    return cleaned(spark, sf).select("loan_id", binary_label(plan.COLLECTIONS).alias("label"))


def positive_rows(spark, sf):
    return where_equal(feature_rows(spark, sf), "label", 1)


def class_share(spark, sf):
    return aggregates.class_share(feature_rows(spark, sf), "label")


def balancing_ratio(spark, sf):
    return aggregates.balancing_ratio(feature_rows(spark, sf), "label")


def class_weights(spark, sf):
    weighted = features.weigh_classes(feature_rows(spark, sf))
    return weighted.select("loan_id", "label", "classWeight")


def class_weights_train_ratio(spark, sf):
    rows = feature_rows(spark, sf)
    train, _ = plan.train_test(rows)
    weighted = features.weigh_classes(rows, ratio_from=train)
    return weighted.select("loan_id", "label", "classWeight")


def toxic_share(spark, sf):
    return aggregates.class_share(table(spark, sf, "labels"), "toxic")


def toxic_weights(spark, sf):
    weighted = features.weigh_classes(table(spark, sf, "labels"), "toxic")
    return weighted.select("doc_id", "toxic", "classWeight")


def hash_split(spark, sf):
    bucket = hash_bucket("loan_id", seed=plan.SPLIT_SEED)
    return feature_rows(spark, sf).select(
        "loan_id",
        bucket.alias("bucket"),
        F.when(bucket < 7000, "train").otherwise("test").alias("part"),
    )


def random_split(spark, sf):
    parts = features.random_split(feature_rows(spark, sf), [0.7, 0.3], plan.SPLIT_SEED)
    named = [p.select("loan_id", F.lit(n).alias("part")) for p, n in zip(parts, ("train", "test"))]
    return named[0].unionByName(named[1])


def random_split_whole(spark, sf):
    # the parts are random, their union is not: every row once
    return random_split(spark, sf).select("loan_id")


def stratified_counts(spark, sf):
    parts = stratified.stratified_split(feature_rows(spark, sf), "label", 0.7, plan.SPLIT_SEED)
    named = [p.select("label", F.lit(n).alias("part")) for p, n in zip(parts, ("train", "test"))]
    return named[0].unionByName(named[1]).groupBy("label", "part").agg(F.count(F.lit(1)).alias("rows"))


def stratified_whole(spark, sf):
    # the parts are random, their union is not: every row once
    train, test = stratified.stratified_split(feature_rows(spark, sf), "label", 0.7, plan.SPLIT_SEED)
    return train.unionByName(test)


# --- evaluation of given predictions ----------------------------------------------------


def rule_scores(spark, sf):
    """Score = loan amount; predicted positive above 29,166."""
    weighted = features.weigh_classes(feature_rows(spark, sf))
    return weighted.select(
        "loan_id",
        "label",
        "classWeight",
        F.col("loan_amnt").cast("double").alias("score"),
        (F.col("loan_amnt") > 29166).cast("int").alias("prediction"),
    )


def auroc_exact(spark, sf):
    return evaluation.area_under_roc(rule_scores(spark, sf))


def confusion_counts(spark, sf):
    return evaluation.confusion(rule_scores(spark, sf))


def precision_by_label(spark, sf):
    return evaluation.precision_by_label(rule_scores(spark, sf))


def roc_points(spark, sf):
    points = evaluation.roc_curve(rule_scores(spark, sf))
    return points.select(*[F.round(c, 9).alias(c) for c in ("fpr", "tpr")])


def precision_never_predicted(spark, sf):
    never = rule_scores(spark, sf).withColumn("prediction", F.lit(0))
    rows = evaluation.precision_by_label(never)
    return rows.withColumn("precision", F.round("precision", 9))


def split_without_key(spark, sf):
    # the reference's table has no loan number: copies of a row stay in one part
    train, test = plan.train_test(feature_rows(spark, sf).drop("loan_id"))
    both = train.withColumn("train", F.lit(1)).unionByName(test.withColumn("train", F.lit(0)))
    parts = both.groupBy("label", *plan.FEATURES).agg(
        F.count(F.lit(1)).alias("copies"), F.countDistinct("train").alias("parts")
    )
    return parts.agg(F.sum("copies").alias("rows"), F.max("parts").alias("most_parts"))


def fraction_labels(spark, sf):
    # a count that is a fraction, beyond int, or text
    price = F.col("o_totalprice")
    orders = table(spark, sf, "orders")
    big = F.when(F.col("o_orderkey") % 3 == 0, F.lit(0.0)).otherwise(price * 100000.0)
    text = F.when(F.col("o_orderkey") % 3 == 0, "0.0").when(F.col("o_orderkey") % 3 == 1, "1.5").otherwise("n/a")
    return orders.select(
        "o_orderkey", binary_label(price - F.floor(price)).alias("fraction_label"),
        binary_label(big).alias("big_label"), binary_label(text).alias("text_label"),
    )


def precision_weighted(spark, sf):
    rows = evaluation.precision_by_label(rule_scores(spark, sf), weight="classWeight")
    return rows.withColumn("precision", F.round("precision", 6))


# --- estimators ---------------------------------------------------------------------------


def feature_vectors(spark, sf):
    vectors = features.assemble(feature_rows(spark, sf), plan.FEATURES, keep=KEY)
    values = vector_to_array("features")
    return vectors.select(
        "loan_id",
        "label",
        *[values[i].alias(f"{name}_value") for i, name in enumerate(plan.FEATURES)],
    )


def dt_predictions(spark, sf):
    _, predictions = plan.fit_tree(stored_features(spark, sf))
    return plan.scored(predictions)


def saved_and_reloaded(spark, sf):
    rows = stored_features(spark, sf)
    model, before = plan.fit_tree(rows)
    path = scratch_dir(spark, "model")
    models.save_model(model, path)
    _, test = plan.train_test(features.assemble(rows, plan.FEATURES, keep=KEY))
    return before, models.load_model("tree", path).transform(test)


def dt_reloaded(spark, sf):
    return plan.scored(saved_and_reloaded(spark, sf)[1])


def dt_reload_agreement(spark, sf):
    before, after = map(plan.scored, saved_and_reloaded(spark, sf))
    before = before.select("loan_id", *[F.col(c).alias(f"{c}_before") for c in ("score", "prediction")])
    same = (F.col("score") == F.col("score_before")) & (
        F.col("prediction") == F.col("prediction_before")
    )
    return after.join(before, "loan_id").agg(
        F.count(F.lit(1)).alias("scored_rows"), F.count_if(same).alias("equal_rows")
    )


def dt_expression_agreement(spark, sf):
    rows = stored_features(spark, sf)
    model, scored = plan.fit_tree(rows)
    path = scratch_dir(spark, "model")
    models.save_model(model, path)
    _, test = plan.train_test(rows)
    ruled = tree_rules.score_by_rules(test, path, plan.FEATURES).select(
        "loan_id", F.col("score").alias("ruled_score"), F.col("prediction").alias("ruled_prediction")
    )
    same = (F.col("score") == F.col("ruled_score")) & (F.col("prediction") == F.col("ruled_prediction"))
    return plan.scored(scored).join(ruled, "loan_id").agg(
        F.count(F.lit(1)).alias("scored_rows"), F.count_if(same).alias("equal_rows")
    )


def dt_group_scores(spark, sf):
    # one yes/no feature: the tree's probabilities are the class shares of the two groups
    rows = loans(spark, sf).select(
        (F.col("revol_bal") > 5000).cast("int").alias("label"),
        (F.col("annual_inc") > 60000).cast("int").alias("high_income"),
    )
    vectors = features.assemble(rows, ["high_income"], keep=["high_income"])
    scored = models.fit(models.decision_tree(), vectors).transform(vectors)
    flat = evaluation.score_rows(scored, "high_income")
    return flat.groupBy("high_income").agg(
        F.round(F.max("score"), 6).alias("score"), F.max("prediction").alias("prediction")
    )


def lr_predictions(spark, sf):
    model, _, test = plan.fit_logistic(feature_rows(spark, sf))
    return plan.scored(model.evaluate(test).predictions)


def lr_enet(spark, sf):
    model, _, test = plan.fit_logistic(
        feature_rows(spark, sf), maxIter=10, regParam=0.3, elasticNetParam=0.8
    )
    return plan.scored(model.transform(test))


def lr_precision(spark, sf):
    model, _, _ = plan.fit_logistic(feature_rows(spark, sf))
    scored = evaluation.score_rows(model.summary.predictions, "label", "classWeight")
    return evaluation.precision_by_label(scored, weight="classWeight")


def lr_evaluate(spark, sf):
    model, _, test = plan.fit_logistic(feature_rows(spark, sf))
    scored = evaluation.score_rows(model.evaluate(test).predictions, "label", "classWeight")
    return evaluation.roc_curve(scored, weight="classWeight")


def lr_auroc(spark, sf):
    model, _, test = plan.fit_logistic(feature_rows(spark, sf))
    # scored once, measured twice
    predictions = materialize(
        model.transform(test).select("label", "rawPrediction", "probability", "prediction"), "predictions"
    )
    exact = evaluation.area_under_roc(evaluation.score_rows(predictions, "label"))
    binned = evaluation.area_under_roc_binned(predictions)
    return exact.withColumn("area_under_roc_binned", F.lit(binned))


def lr_group_scores(spark, sf):
    # one yes/no feature: the fitted probabilities are the weighted class shares per group
    weighted = features.weigh_classes(table(spark, sf, "labels"), "toxic")
    vectors = features.assemble(
        weighted, ["quality"], label="toxic", keep=["quality", "classWeight"]
    )
    model = models.fit(models.logistic_regression(label="toxic"), vectors, label="toxic")
    flat = evaluation.score_rows(model.transform(vectors), "quality")
    return flat.groupBy("quality").agg(F.round(F.max("score"), 3).alias("score"))


def ml_flow(spark, sf):
    train, test = plan.train_test(features.weigh_classes(stored_features(spark, sf)))
    model = models.fit(models.flow(plan.FEATURES, models.logistic_regression()), train)
    return plan.scored(model.transform(test))


def flow_reload_agreement(spark, sf):
    # from raw texts to scores, saved, loaded, and applied to rows without the label's source
    train, test = plan.train_test(materialize(loans(spark, sf), "raw"))
    flow = raw_flow(plan.UNIT_RULES, plan.COLLECTIONS, plan.FEATURES, models.logistic_regression())
    model = flow.fit(train)
    path = scratch_dir(spark, "flow")
    models.save_model(model, path)
    before = score_columns(model.transform(test), "before")
    after = score_columns(models.load_model("flow", path).transform(test.drop(plan.COLLECTIONS)), "after")
    same = F.col("score_before") == F.col("score_after")
    return before.join(after, "loan_id").agg(
        F.count(F.lit(1)).alias("scored_rows"), F.count_if(same).alias("equal_rows")
    )


def score_columns(predictions, when):
    return evaluation.score_rows(predictions, "loan_id").select("loan_id", F.col("score").alias(f"score_{when}"))


def lr_prediction_rows(spark, sf):
    # every test row is predicted once, by its score
    return lr_predictions(spark, sf).select(
        "loan_id", "label", ((F.col("score") > 0.5).cast("int") == F.col("prediction")).alias("by_score")
    )


def lr_enet_conditions(spark, sf):
    # at the optimum the gradient of each scaled coefficient is balanced by its penalties
    reg, mix = 0.01, 0.8
    model, train, _ = plan.fit_logistic(
        feature_rows(spark, sf), maxIter=200, tol=1e-10, regParam=reg, elasticNetParam=mix
    )
    holds = models.optimality(model, train, reg, mix)
    return holds.select(
        F.array(*map(F.lit, plan.FEATURES))[F.col("feature")].alias("feature_name"),
        (F.col("gap") < 1e-4).alias("holds"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "loans_by_state": loans_by_state,
    "loan_fixture": loans,
    "loan_columns": loan_columns,
    "etl_clean": cleaned,
    "etl_term": etl_term,
    "etl_keep_source": etl_keep_source,
    "parse_failures": parse_failures,
    "unreadable_terms": unreadable_terms,
    "priority_number": priority_number,
    "brand_number": brand_number,
    "customer_number": customer_number,
    "count_all": count_all,
    "collections_rows": collections_rows,
    "count_collections": count_collections,
    "collections_text_filter": collections_text_filter,
    "status_counts": status_counts,
    "state_grade_counts": state_grade_counts,
    "describe_schema": describe_schema,
    "numeric_columns": numeric_columns,
    "non_numeric_columns": non_numeric_columns,
    "preview": preview,
    "first_row": first_row,
    "user_stamp": user_stamp,
    "sql_etl": sql_etl,
    "sql_collections_by_state": sql_collections_by_state,
    "sql_view_chain": sql_view_chain,
    "sql_join": sql_join,
    "sql_window": sql_window,
    "sql_sort_limit": sql_sort_limit,
    "sql_set_op": sql_set_op,
    "csv_roundtrip": csv_roundtrip,
    "csv_schema_roundtrip": csv_schema_roundtrip,
    "csv_sql_view": csv_sql_view,
    "csv_corrupt_rows": csv_corrupt_rows,
    "table_roundtrip": table_roundtrip,
    "table_replaced": table_replaced,
    "table_sql_view": table_sql_view,
    "partitioned_roundtrip": partitioned_roundtrip,
    "partition_filter": partition_filter,
    "repartition_rows": repartition_rows,
    "repartition_salted": repartition_salted,
    "ctas_roundtrip": ctas_roundtrip,
    "ctas_at_path": ctas_at_path,
    "insert_overwrite": insert_overwrite,
    "enforced_write": enforced_write,
    "required_nulls": required_nulls,
    "manifest": manifest,
    "zip_landing": zip_landing,
    "manifest_delta": manifest_delta,
    "insert_overwrite_partition": insert_overwrite_partition,
    "enforced_quarantine": enforced_quarantine,
    "clustered_roundtrip": clustered_roundtrip,
    "bucketed_join": bucketed_join,
    "inferred_types": inferred_types,
    "stream_state_counts": stream_state_counts,
    "stream_etl": stream_etl,
    "binary_labels": binary_labels,
    "feature_rows": feature_rows,
    "positive_rows": positive_rows,
    "class_share": class_share,
    "balancing_ratio": balancing_ratio,
    "class_weights": class_weights,
    "class_weights_train_ratio": class_weights_train_ratio,
    "toxic_share": toxic_share,
    "toxic_weights": toxic_weights,
    "hash_split": hash_split,
    "random_split": random_split,
    "random_split_whole": random_split_whole,
    "stratified_counts": stratified_counts,
    "stratified_whole": stratified_whole,
    "auroc_exact": auroc_exact,
    "confusion_counts": confusion_counts,
    "precision_by_label": precision_by_label,
    "precision_weighted": precision_weighted,
    "precision_never_predicted": precision_never_predicted,
    "roc_points": roc_points,
    "split_without_key": split_without_key,
    "fraction_labels": fraction_labels,
    "feature_vectors": feature_vectors,
    "dt_predictions": dt_predictions,
    "dt_reloaded": dt_reloaded,
    "dt_reload_agreement": dt_reload_agreement,
    "dt_expression_agreement": dt_expression_agreement,
    "dt_group_scores": dt_group_scores,
    "lr_predictions": lr_predictions,
    "lr_enet": lr_enet,
    "lr_precision": lr_precision,
    "lr_evaluate": lr_evaluate,
    "lr_auroc": lr_auroc,
    "lr_group_scores": lr_group_scores,
    "ml_flow": ml_flow,
    "flow_reload_agreement": flow_reload_agreement,
    "lr_prediction_rows": lr_prediction_rows,
    "lr_enet_conditions": lr_enet_conditions,
}


LLM_QUERIES, LLM_ORACLES = {}, {}
# the training-data operators can be left out, whole; a fault inside of them is not hidden
if all(map(importlib.util.find_spec, ("corpus_pipeline", "loanloom.llm"))) and importlib.util.find_spec("loanloom.llm.queries"):
    import corpus_pipeline
    from loanloom.llm.queries import ORACLES as LLM_ORACLES
    from loanloom.llm.queries import QUERIES as LLM_QUERIES

    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLES = LLM_ORACLES | {"pipeline": corpus_pipeline.ORACLE_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    """SQL per query; absent for a listing of files, an unordered preview, iterative fits and
    training-data operators that SQL cannot express."""
    return ORACLES | LLM_ORACLES
