"""The loan table: which columns it has, how it is cleaned, what is asked of it."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame

from loanloom.operators.aggregates import group_count
from loanloom.operators.cleaning import UnitRule, parse_failures, parse_units
from loanloom.operators.evaluation import score_rows
from loanloom.operators.features import assemble, feature_rows, key_split, weigh_classes
from loanloom.operators.filters import where_not_equal
from loanloom.operators.models import decision_tree, fit, logistic_regression
from loanloom.plans.statements import run_sql
from loanloom.session import materialize

# Column names, separators, seeds and fractions of the loan data set.
WORKING_COLUMNS = [
    "loan_amnt",
    "term",
    "int_rate",
    "installment",
    "grade",
    "emp_length",
    "annual_inc",
    "addr_state",
    "dti",
    "delinq_2yrs",
    "inq_last_6mths",
    "mths_since_last_delinq",
    "revol_bal",
    "revol_util",
    "out_prncp",
    "total_pymnt",
    "total_rec_prncp",
    "total_rec_int",
    "collections_12_mths_ex_med",
]
TERM_RULE = UnitRule("term", "newTerm", " ", 1, "int")
UNIT_RULES = [
    TERM_RULE,
    UnitRule("int_rate", "intRate", "%", 0, "double"),
    UnitRule("revol_util", "revolUtil", "%", 0, "double"),
]
COLLECTIONS = "collections_12_mths_ex_med"
STATE = "addr_state"
FEATURES = [
    "loan_amnt",
    "installment",
    "annual_inc",
    "dti",
    "revol_bal",
    "out_prncp",
    "total_pymnt",
    "total_rec_prncp",
    "total_rec_int",
    "intRate",
    "revolUtil",
]
SPLIT_SEED = 784
TRAIN_FRACTION = 0.7
TREE_SEED = 1028


def working_columns(loans: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return loans.select(*keep, *WORKING_COLUMNS)


def clean(loans: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The working columns with term, rate and utilisation as numbers."""
    return parse_units(working_columns(loans, keep), UNIT_RULES)


def clean_term(loans: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Only the first cleaning step: the term as a number."""
    return parse_units(working_columns(loans, keep), [TERM_RULE])


def unreadable_units(loans: DataFrame) -> DataFrame:
    return parse_failures(loans, UNIT_RULES)


def with_collections(loans: DataFrame) -> DataFrame:
    """Loans whose number of collections is known and not 0."""
    return where_not_equal(loans, COLLECTIONS, 0)


def collections_by_state(loans: DataFrame) -> DataFrame:
    return group_count(with_collections(loans), STATE)


def clean_sql(loans: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """SQL form of :func:`clean`."""
    return run_sql(
        loans.sparkSession,
        """
        select * except (term, int_rate, revol_util),
               try_cast(get(split(term, ' '), 1) as int) as newTerm,
               try_cast(get(split(int_rate, '%'), 0) as double) as intRate,
               try_cast(get(split(revol_util, '%'), 0) as double) as revolUtil
        from {loans}
        """,
        loans=working_columns(loans, keep),
    )


def collections_by_state_sql(loans: DataFrame) -> DataFrame:
    """SQL form of :func:`collections_by_state`."""
    return run_sql(
        loans.sparkSession,
        """
        select addr_state, count(*) as count
        from {loans} where collections_12_mths_ex_med <> :none
        group by addr_state
        """,
        args={"none": 0},
        loans=loans,
    )


def features(cleaned: DataFrame, keep: tuple[str, ...] = ("loan_id",)) -> DataFrame:
    """Label and the eleven features of complete rows."""
    return feature_rows(cleaned, COLLECTIONS, FEATURES, keep=keep)


def train_test(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """70 to 30, by loan number if there is one, else by the features, so copies stay together."""
    if "loan_id" in rows.columns:
        return key_split(rows, ["loan_id"], TRAIN_FRACTION, SPLIT_SEED)
    return key_split(rows, FEATURES, TRAIN_FRACTION, SPLIT_SEED, portable=False)


def _assembled_parts(rows: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    keep = [c for c in ("loan_id", *keep) if c in rows.columns]
    train, test = (assemble(part, FEATURES, keep=keep) for part in train_test(rows))
    return train, test


def fit_tree(rows: DataFrame, **params) -> tuple[Model, DataFrame]:
    """Unweighted tree on the training part; returns the model and the scored test part."""
    train, test = _assembled_parts(rows)
    model = fit(decision_tree(seed=TREE_SEED, **params), train)
    return model, model.transform(test)


def weighted_parts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assembled training and test part with class weights from all rows.

    The weighted rows are stored: the ratio is computed once, not by every job that reads a part.
    """
    return _assembled_parts(materialize(weigh_classes(rows), "weighted"), "classWeight")


def fit_logistic(rows: DataFrame, **params) -> tuple[Model, DataFrame, DataFrame]:
    """Class-weighted regression; returns the model, the training and the test part."""
    train, test = weighted_parts(rows)
    return fit(logistic_regression(**params), train), train, test


def scored(predictions: DataFrame) -> DataFrame:
    return score_rows(predictions, "loan_id", "label")
