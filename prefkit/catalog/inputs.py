"""Tables the catalogued queries start from, each written once per session and data folder."""

from __future__ import annotations

from collections.abc import Callable
import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefkit.operators.lexical_reward import fit_log_odds
from prefkit.operators.splits import seeded_split, side
from prefkit.operators.vocabulary import Vocabulary, build_vocabulary
from prefkit.plans.training_sets import pair_texts
from prefkit.session import shared_folder
from prefkit.sources import derived
from prefkit.sources.files import is_complete
from prefkit.sources.tables import cached_copy

SYSTEM = "You are a helpful assistant."
SEED = 42


def _stored(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    place = hashlib.md5(folder.encode()).hexdigest()[:12]
    path = f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{place}/{name}"
    return spark.read.parquet(path) if is_complete(spark, path) else cached_copy(make(), path)


def preferences(spark: SparkSession, folder: str) -> DataFrame:
    """row_id, question, chosen, rejected, rejected_id."""
    return _stored(spark, folder, "preferences", lambda: derived.labelled_preferences(spark, folder))


def exchanges(spark: SparkSession, folder: str) -> DataFrame:
    """row_id, conv_id, turn, question, answer, other."""
    return _stored(spark, folder, "exchanges", lambda: derived.other_answers(derived.exchanges(spark, folder)))


def fit_weights(spark: SparkSession, folder: str) -> DataFrame:
    train = side(seeded_split(preferences(spark, folder), 0.05, SEED), "train")
    return fit_log_odds(train, *pair_texts(SYSTEM))


def weights(spark: SparkSession, folder: str) -> DataFrame:
    """Word weights fitted on the train side of the preferences."""
    return _stored(spark, folder, "weights", lambda: fit_weights(spark, folder))


def fit_vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    return build_vocabulary(derived.table(spark, folder, "documents"), F.col("text"))


def vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    """Words of all documents."""
    return Vocabulary(_stored(spark, folder, "vocabulary", lambda: fit_vocabulary(spark, folder).table))
