"""The named queries. Each takes (spark, data folder) and reads whole tables.

Arrays leave as joined strings and scores rounded to six places, so that
another engine can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from prefkit import schemas
from prefkit.catalog import inputs
from prefkit.catalog.inputs import SEED, SYSTEM
from prefkit.functions import chat, scores as sc, text as tx, tokens as tk
from prefkit.operators import batching, metrics
from prefkit.operators.bradley_terry import bradley_terry_scorer, fit_bradley_terry
from prefkit.operators.inference import batch_score_udf, encode_udf, generate, model_scorer
from prefkit.operators.lexical_reward import fit_log_odds, log_odds_scorer
from prefkit.operators.positions import hash_rank
from prefkit.operators.sampling import length_draw, sample_rows
from prefkit.operators.splits import eval_rows, ordered_split, seeded_split, side
from prefkit.operators.vocabulary import PAD_ID, SPECIALS, decode, encode
from prefkit.plans import model_comparison as cmp
from prefkit.plans.pairwise_eval import judged, pairwise_eval, score_pairs
from prefkit.plans.rollouts import generated_responder, rollouts, step_prompts, stored_responder
from prefkit.plans.training_sets import build_pairs, build_prompts, build_sft, pair_texts
from prefkit.session import fresh_path
from prefkit.sources import derived, sinks, tables
from prefkit.sources.questions import question_list
from prefkit.sources.files import written
from prefkit.streaming import questions as qs, step_rewards as sr
from prefkit.streaming.replay import write_end, write_slices
from prefkit.streaming.sessions import open_sessions, until_stop

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(run: Query) -> Query:
    CATALOG[run.__name__] = run
    return run


def joined(array: Column) -> Column:
    return F.array_join(array.cast("array<string>"), " ")


def big(value: Column) -> Column:
    return value.cast("bigint")


def places(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name).cast("double"), digits).alias(name)


def message_rows(df: DataFrame, messages: Column, *keys: str) -> DataFrame:
    return df.select(*keys, F.posexplode(messages).alias("idx", "m")).select(
        *keys, big(F.col("idx")).alias("idx"), "m.role", "m.content"
    )


# Sources and sinks


@query
def scan_preferences(spark, folder):
    """Preferences written once by split, then the train folder read under its schema."""
    parted = seeded_split(inputs.preferences(spark, folder), 0.05, SEED).drop("rejected_id")
    path = fresh_path(spark, "preferences")
    tables.cached_copy(parted, path, "split")
    return tables.load_preferences(spark, path, split="train")


@query
def scan_unkeyed_preferences(spark, folder):
    """A three-column table loaded with keys; rows whose key is not unique would be missing."""
    source = fresh_path(spark, "unkeyed")
    inputs.preferences(spark, folder).select("question", "chosen", "rejected").write.parquet(source)
    rows = tables.load_unkeyed_preferences(spark, source, fresh_path(spark, "keyed"))
    unique = F.count(F.lit(1)).over(W.partitionBy("row_id"))
    return rows.withColumn("n", unique).where("n = 1").drop("row_id", "n")


@query
def read_responses(spark, folder):
    """Saved answers read back by key and joined to their questions."""
    rows = inputs.exchanges(spark, folder)
    path = fresh_path(spark, "responses")
    rows.select("row_id", F.col("answer").alias("response")).write.parquet(path)
    return rows.select("row_id", "question").join(tables.load_responses(spark, path), "row_id")


@query
def csv_round_trip(spark, folder):
    path = fresh_path(spark, "comparison")
    sinks.write_comparison_csv(_comparison(spark, folder), path)
    back = sinks.read_comparison_csv(spark, path)
    return back.select(
        "question", "sft_response", "ppo_response", places("sft_rm_score"), places("ppo_rm_score"), places("score_diff")
    )


@query
def step_metrics_log(spark, folder):
    """Step tables of two runs appended to one log and read back."""
    path = fresh_path(spark, "metrics")
    for run, answer in (("a", "answer"), ("b", "other")):
        steps = metrics.step_rewards(_rollouts(spark, folder, answer, run))
        sinks.append_step_metrics(steps, path)
    log = tables.read_table(spark, path, schemas.STEP_METRICS)
    return log.select("run_id", big(F.col("step")).alias("step"), "n", places("mean_reward"))


@query
def export_pairs(spark, folder):
    """Pairs written by split and bucketed by batch, read back through the table."""
    rows = build_pairs(inputs.preferences(spark, folder), SYSTEM, inputs.vocabulary(spark, folder), max_len=None)
    keys = seeded_split(inputs.preferences(spark, folder).select("row_id"), 0.05, SEED)
    placed = batching.micro_batches(rows, seed=SEED, keys=keys, by=["split"])
    path = fresh_path(spark, "pairs")
    table = f"pairs_{path.rsplit('-', 1)[1]}"
    sinks.export_training_set(placed, table, path, buckets=8)
    return spark.table(table).select(
        "row_id", "batch_id", "split", joined(F.col("input_ids_chosen")).alias("chosen"), joined(F.col("input_ids_rejected")).alias("rejected")
    )


# Messages and prompts


@query
def messages_sft(spark, folder):
    rows = inputs.preferences(spark, folder)
    return message_rows(rows, chat.answered_messages(SYSTEM, F.col("question"), F.col("chosen")), "row_id")


@query
def messages_pairs(spark, folder):
    rows, question = inputs.preferences(spark, folder), F.col("question")
    sides = F.array(
        *[
            F.struct(F.lit(s).alias("side"), chat.answered_messages(SYSTEM, question, F.col(s)).alias("messages"))
            for s in ("chosen", "rejected")
        ]
    )
    return message_rows(rows.select("row_id", F.inline(sides)), F.col("messages"), "row_id", "side")


@query
def messages_prompt(spark, folder):
    return message_rows(inputs.exchanges(spark, folder), chat.prompt_messages(SYSTEM, F.col("question")), "row_id")


@query
def messages_scoring(spark, folder):
    """An empty system text still makes a message."""
    messages = chat.answered_messages("", F.col("question"), F.col("answer"))
    return message_rows(inputs.exchanges(spark, folder), messages, "row_id")


@query
def render_chat(spark, folder):
    chosen, rejected = pair_texts(SYSTEM)
    return inputs.preferences(spark, folder).select("row_id", chosen.alias("chosen_text"), rejected.alias("rejected_text"))


@query
def render_prompt(spark, folder):
    messages = chat.prompt_messages(SYSTEM, F.col("question"))
    return inputs.exchanges(spark, folder).select("row_id", chat.render(messages, opener=True).alias("prompt"))


@query
def render_no_think(spark, folder):
    messages = chat.prompt_messages(SYSTEM, F.col("question"))
    return inputs.exchanges(spark, folder).select(
        "row_id", chat.render(messages, opener=True, thinking=False).alias("prompt")
    )


@query
def trimmed_texts(spark, folder):
    """Every turn trimmed, lowered, checked for the stop word and given a default."""
    turns = derived.table(spark, folder, "conversations")
    return turns.select(
        "conv_id",
        "turn",
        F.lower(tx.strip_all(F.col("text"))).alias("trimmed"),
        tx.is_stop_word(F.col("text")).alias("stops"),
        tx.or_default(F.when(F.col("role") == "system", "").otherwise(F.col("text")), SYSTEM).alias("filled"),
    )


# Splits and samples


@query
def split_ordered(spark, folder):
    return ordered_split(inputs.exchanges(spark, folder).select("row_id"), 0.1)


@query
def split_seeded_5(spark, folder):
    return seeded_split(inputs.preferences(spark, folder).select("row_id"), 0.05, SEED)


@query
def split_seeded_10(spark, folder):
    return seeded_split(inputs.exchanges(spark, folder).select("row_id"), 0.1, SEED)


@query
def split_replay(spark, folder):
    """One job's split against another's over rows laid out differently, and against the larger split."""
    rows = inputs.preferences(spark, folder).select("row_id")
    first = seeded_split(rows, 0.05, SEED).withColumnRenamed("split", "split_5")
    again = seeded_split(rows.repartition("row_id"), 0.05, SEED).withColumnRenamed("split", "replayed")
    larger = seeded_split(rows, 0.1, SEED).withColumnRenamed("split", "split_10")
    both = first.join(again, "row_id").join(larger, "row_id")
    return both.groupBy("split_5", "replayed", "split_10").agg(F.count(F.lit(1)).alias("n"))


@query
def split_sides(spark, folder):
    """Rows and characters of either side, each read through its own filter."""
    rows = seeded_split(inputs.preferences(spark, folder), 0.05, SEED)
    size = [F.count(F.lit(1)).alias("n"), F.sum(F.length("chosen") + F.length("rejected")).alias("chars")]
    return side(rows, "train").groupBy("split").agg(*size).unionByName(side(rows, "test").groupBy("split").agg(*size))


@query
def eval_head_100(spark, folder):
    return eval_rows(inputs.exchanges(spark, folder), 0.5, SEED, first=100).select("row_id", "question")


@query
def sample_questions(spark, folder):
    return sample_rows(inputs.exchanges(spark, folder), 50, SEED).select("row_id", "question")


@query
def union_common(spark, folder):
    """All questions in the place of a sample, and the literal list."""
    return cmp.comparison_questions(inputs.exchanges(spark, folder), question_list(spark), None)


# Tokens


@query
def vocab(spark, folder):
    return inputs.fit_vocabulary(spark, folder).table


def _ids(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(
        F.col(key).alias("row_id"),
        joined(F.col(name)).alias("ids"),
        joined(tk.attention_mask(F.col(name))).alias("mask"),
        big(F.size(name)).alias("n_ids"),
        F.col(f"{name}_cut").alias("was_truncated"),
    )


@query
def encode_documents(spark, folder):
    documents = derived.table(spark, folder, "documents")
    return _ids(encode(documents, "doc_id", {"ids": F.col("text")}, inputs.vocabulary(spark, folder)), "doc_id", "ids")


SIDES = ("chosen", "rejected")


def _pair_ids(spark: SparkSession, folder: str, max_len: int | None = None) -> DataFrame:
    texts = dict(zip(SIDES, pair_texts(SYSTEM)))
    return encode(inputs.preferences(spark, folder), "row_id", texts, inputs.vocabulary(spark, folder), max_len)


@query
def encode_truncated(spark, folder):
    """Both rendered conversations, cut to 512 ids."""
    ids = _pair_ids(spark, folder, max_len=512)
    out = [_ids(ids, "row_id", name).withColumn("side", F.lit(name)) for name in SIDES]
    return out[0].unionByName(out[1])


@query
def decode_texts(spark, folder):
    """Both conversations encoded and decoded, with the markers and without."""
    words = inputs.vocabulary(spark, folder)
    sides = F.array(*[F.struct(F.lit(n).alias("side"), F.col(n).alias("ids")) for n in SIDES])
    ids = _pair_ids(spark, folder).select("row_id", F.inline(sides)).select(F.concat_ws("|", "row_id", "side").alias("name"), "ids")
    ids = written(ids, "pair-ids")
    both = decode(ids, "name", "ids", words, name="kept").join(decode(ids, "name", "ids", words, skip_special=True, name="plain"), "name")
    parts = F.split("name", r"\|")
    return both.select(parts[0].cast("bigint").alias("row_id"), parts[1].alias("side"), "kept", "plain")


def _exchange_ids(spark: SparkSession, folder: str) -> DataFrame:
    prompt = chat.render(chat.prompt_messages(SYSTEM, F.col("question")), opener=True)
    texts = {"prompt": prompt, "response": F.col("answer")}
    return encode(inputs.exchanges(spark, folder), "row_id", texts, inputs.vocabulary(spark, folder))


@query
def prompt_response_concat(spark, folder):
    ids = _exchange_ids(spark, folder)
    full = tk.join_ids(F.col("prompt"), F.col("response"))
    return ids.select("row_id", joined(full).alias("full_ids"), joined(tk.drop_ids(full, range(len(SPECIALS)))).alias("plain_ids"))


@query
def strip_prompt(spark, folder):
    ids = _exchange_ids(spark, folder).withColumn("full", tk.join_ids(F.col("prompt"), F.col("response")))
    return ids.select("row_id", joined(tk.strip_prompt(F.col("full"), F.col("prompt"))).alias("new_ids"))


def _batched_ids(spark: SparkSession, folder: str) -> DataFrame:
    prompts = _exchange_ids(spark, folder).select("row_id", "prompt")
    return batching.micro_batches(prompts, rows=8, accumulate=1, seed=SEED, keys=inputs.exchanges(spark, folder))


@query
def pad_batch(spark, folder):
    pad = tk.padding_id(None, PAD_ID)
    padded = batching.pad_batches(_batched_ids(spark, folder), "prompt", pad)
    return padded.select("row_id", "batch_id", joined(F.col("prompt")).alias("ids"), joined(F.col("mask")).alias("mask"))


@query
def batch_widths(spark, folder):
    return batching.batch_widths(_batched_ids(spark, folder), "prompt")


@query
def micro_batches(spark, folder):
    return batching.micro_batches(inputs.exchanges(spark, folder).select("row_id"))


# Rewards and pairwise evaluation


def _scorer(spark: SparkSession, folder: str):
    return log_odds_scorer(inputs.weights(spark, folder))


@query
def token_log_odds(spark, folder):
    fitted = inputs.fit_weights(spark, folder)
    return fitted.select("tok", "c", "r", places("weight"))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return score_pairs(inputs.preferences(spark, folder), _scorer(spark, folder), SYSTEM)


@query
def score_preferences(spark, folder):
    return _scored(spark, folder).select("row_id", places("chosen_score"), places("rejected_score"))


@query
def score_float32(spark, folder):
    """One-element logit arrays taken apart and cast, as a batch model returns them."""
    logits = _scored(spark, folder).withColumn("logits", F.array("chosen_score"))
    return logits.select("row_id", sc.first_logit(F.col("logits")).cast("float").cast("double").alias("reward")).select(
        "row_id", places("reward", 4)
    )


@query
def pairwise_labels(spark, folder):
    """Sample number, both scores as printed and the verdict, for the whole test side."""
    held_out = eval_rows(inputs.preferences(spark, folder), 0.05, SEED)
    scored = judged(score_pairs(held_out, _scorer(spark, folder), SYSTEM))
    return hash_rank(scored, "row_id", SEED, name="sample_no", keys=held_out).select(
        "row_id",
        "sample_no",
        sc.four_places(F.col("chosen_score")).alias("chosen_score"),
        sc.four_places(F.col("rejected_score")).alias("rejected_score"),
        "verdict",
    )


@query
def pairwise_accuracy(spark, folder):
    rows = inputs.preferences(spark, folder)
    return pairwise_eval(rows, _scorer(spark, folder), SYSTEM, first=None)


@query
def pairwise_accuracy_first(spark, folder):
    """The published protocol: texts cut to 512 words, at most 100 rows, fitted in the same job."""
    rows = inputs.preferences(spark, folder)
    train = side(seeded_split(rows, 0.05, SEED), "train")
    fitted = fit_log_odds(train, *pair_texts(SYSTEM), max_len=512)
    return pairwise_eval(rows, log_odds_scorer(fitted, max_len=512), SYSTEM, first=100)


@query
def pairwise_accuracy_hard(spark, folder):
    """True replies against other replies of the conversation; lone exchanges tie."""
    rows = derived.hard_preferences(spark, folder)
    fitted = fit_log_odds(side(seeded_split(rows, 0.05, SEED), "train"), *pair_texts(SYSTEM))
    return pairwise_eval(rows, log_odds_scorer(fitted), SYSTEM)


@query
def pairwise_loss(spark, folder):
    return metrics.pairwise_loss(_scored(spark, folder)).select(*[places(c) for c in ("rank_loss", "center_loss", "loss")])


@query
def bradley_terry(spark, folder):
    """Accuracy and mean margin on the test side; the gradient certifies that the only optimum is near."""
    rows = inputs.preferences(spark, folder)
    model = fit_bradley_terry(side(seeded_split(rows, 0.05, SEED), "train"), *pair_texts(SYSTEM))
    scored = score_pairs(eval_rows(rows, 0.05, SEED), bradley_terry_scorer(model), SYSTEM)
    margin = F.round(F.avg(F.col("chosen_score") - F.col("rejected_score")), 3).alias("mean_margin")
    summary = metrics.pairwise_summary(scored).withColumn("mean_margin", scored.agg(margin).scalar())
    return summary.withColumn("optimal", F.lit(model.distance < 1e-4))


def _spacing():
    """A stand-in for a caller's reward model: the share of spaces."""
    return lambda texts: [t.count(" ") / max(len(t), 1) for t in texts]


@query
def batch_udf_scores(spark, folder):
    documents = derived.table(spark, folder, "documents")
    return documents.select("doc_id", batch_score_udf(_spacing)("text").alias("score")).select("doc_id", places("score", 4))


def _code_points():
    """A stand-in for a caller's tokenizer: the code points of each text of a list."""
    return lambda texts: [[ord(c) for c in t] for t in texts]


@query
def encode_with_hook(spark, folder):
    """Every turn through the hook for a caller's tokenizer."""
    turns = derived.table(spark, folder, "conversations")
    ids = turns.select("conv_id", "turn", encode_udf(_code_points)("text").alias("ids"))
    return ids.select("conv_id", "turn", big(F.size("ids")).alias("n_ids"), big(F.aggregate("ids", F.lit(0).cast("bigint"), lambda s, i: s + i)).alias("total"))


# Comparison of two models


def _comparison(spark: SparkSession, folder: str) -> DataFrame:
    own = inputs.exchanges(spark, folder)
    sft, ppo = derived.stored_answers(spark, folder, own)
    asked = cmp.comparison_questions(own, derived.common_questions(spark, folder), None)
    return cmp.compare(asked, sft, ppo, _scorer(spark, folder))


@query
def compare_rows(spark, folder):
    rows = _comparison(spark, folder)
    return rows.select(
        "source", "row_id", "question", "sft_response", "ppo_response",
        places("sft_rm_score"), places("ppo_rm_score"), places("score_diff"),
    )


def _summary(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    out = metrics.comparison_summary(rows, "sft_rm_score", "ppo_rm_score", by)
    counts = ["n", "n_answered_a", "n_answered_b", "n_paired"]
    return out.select(*(by or []), *counts, places("mean_a"), places("mean_b"), places("lift"), "wins", places("win_rate"))


@query
def compare_summary(spark, folder):
    return _summary(_comparison(spark, folder))


def _comparison_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The comparison when each model has left some questions unanswered."""
    own = inputs.exchanges(spark, folder)
    sft, ppo = derived.stored_answers(spark, folder, own)
    asked = cmp.comparison_questions(own, derived.common_questions(spark, folder), None)
    # Keys of exchanges are large multiples of their conversation, so the hash of the key draws.
    some = lambda name, kept: F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(f"{name}|"), F.col("row_id").cast("string"))), 1, 8), 16, 10).cast("bigint"), F.lit(10)) < kept
    return cmp.compare(asked, sft.where(some("sft", 8)), ppo.where(some("ppo", 7)), _scorer(spark, folder))


@query
def compare_with_gaps(spark, folder):
    """The summary over unanswered questions, in all and by source."""
    rows = _comparison_with_gaps(spark, folder)
    return _summary(rows, ["source"]).unionByName(_summary(rows).withColumn("source", F.lit("all")))


@query
def compare_rows_with_gaps(spark, folder):
    """Unanswered questions keep their rows, without a score or a difference."""
    rows = _comparison_with_gaps(spark, folder)
    return rows.select("source", "row_id", "question", "sft_response", "ppo_response", places("sft_rm_score"), places("ppo_rm_score"), places("score_diff"))


@query
def summary_text(spark, folder):
    """The printed summary."""
    return cmp.summary_text(metrics.comparison_summary(_comparison(spark, folder), "sft_rm_score", "ppo_rm_score"))


@query
def compare_by_source(spark, folder):
    """The summary of the sampled and of the common questions apart."""
    return _summary(_comparison(spark, folder), ["source"])


@query
def compare_sample_50(spark, folder):
    """The published protocol: 50 sampled questions and the common ones, spacing as the score."""
    own = inputs.exchanges(spark, folder)
    sft, ppo = derived.stored_answers(spark, folder, own)
    asked = cmp.comparison_questions(own, derived.common_questions(spark, folder), 50)
    return _summary(cmp.compare(asked, sft, ppo, model_scorer(_spacing)))


MODELS = {"sft": ("sft_response", "sft_rm_score"), "ppo": ("ppo_response", "ppo_rm_score")}


@query
def compare_long(spark, folder):
    long = metrics.long_report(_comparison(spark, folder), cmp.KEYS + ["question"], MODELS)
    return long.select(*cmp.KEYS, "question", "model", "response", places("score"), places("lift"))


@query
def compare_wide(spark, folder):
    long = metrics.long_report(_comparison(spark, folder), cmp.KEYS, MODELS)
    return metrics.wide_report(long, cmp.KEYS, ["sft", "ppo"]).select(*cmp.KEYS, places("sft"), places("ppo"))


@query
def compare_common(spark, folder):
    return cmp.common_report(_comparison(spark, folder))


# Rollouts


def _train_prompts(spark: SparkSession, folder: str) -> DataFrame:
    return side(seeded_split(inputs.exchanges(spark, folder), 0.1, SEED), "train")


def _rollouts(spark: SparkSession, folder: str, answer: str = "answer", run: str = "run") -> DataFrame:
    prompts = step_prompts(_train_prompts(spark, folder), SYSTEM)
    stored = inputs.exchanges(spark, folder).select("row_id", F.col(answer).alias("response"))
    return rollouts(prompts, stored_responder(stored), _scorer(spark, folder), run)


@query
def rollout_prompts(spark, folder):
    """Rows drawn for each step with their length limits; slots in mini-batches of two."""
    drawn = step_prompts(_train_prompts(spark, folder), SYSTEM)
    return drawn.select(
        big(F.col("step")).alias("step"),
        big(F.col("slot")).alias("slot"),
        batching.batch_number(F.col("slot"), 2).alias("mini_batch"),
        "row_id",
        big(F.col("gen_len")).alias("gen_len"),
        "query",
    )


@query
def length_draws(spark, folder):
    """A drawn length for every turn."""
    turns = derived.table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", big(length_draw(SEED, F.col("conv_id"), F.col("turn"))).alias("gen_len"))


@query
def rollout_table(spark, folder):
    rows = _rollouts(spark, folder)
    return rows.select(
        "run_id", big(F.col("step")).alias("step"), big(F.col("slot")).alias("slot"), "row_id",
        big(F.col("gen_len")).alias("gen_len"), "query", "response", places("reward", 4),
    )


def _steps(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.step_rewards(_rollouts(spark, folder))


def _step_columns(steps: DataFrame, *more: str) -> DataFrame:
    return steps.select("run_id", big(F.col("step")).alias("step"), *more, "n", places("mean_reward", 4))


@query
def step_rewards(spark, folder):
    return _step_columns(_steps(spark, folder))


@query
def step_progress(spark, folder):
    return _step_columns(metrics.progress_steps(_steps(spark, folder)))


@query
def snapshot_steps(spark, folder):
    return _step_columns(metrics.snapshot_steps(_steps(spark, folder)), "snapshot")


def _repeater():
    """A stand-in for a caller's generator: the words of the prompt from the end, up to the limit."""
    return lambda prompts, limits: [" ".join(p.split(" ")[::-1][:n]) for p, n in zip(prompts, limits)]


@query
def generate_responses(spark, folder):
    asked = inputs.exchanges(spark, folder).select(
        "row_id", F.col("question").alias("prompt"), length_draw(SEED, F.col("conv_id"), F.col("turn"), 2, 16).alias("gen_len")
    )
    return generate(asked, _repeater, ["row_id"])


@query
def generated_rollouts(spark, folder):
    """Rollouts through the generator and batch-model hooks."""
    prompts = step_prompts(_train_prompts(spark, folder), SYSTEM)
    rows = rollouts(prompts, generated_responder(_repeater), model_scorer(_spacing))
    return _step_columns(metrics.step_rewards(rows))


# Training sets


@query
def build_sft_set(spark, folder):
    rows = build_sft(inputs.preferences(spark, folder), SYSTEM)
    return message_rows(rows, F.col("messages"), "row_id", "split")


@query
def build_pair_set(spark, folder):
    rows = build_pairs(inputs.preferences(spark, folder), SYSTEM, inputs.vocabulary(spark, folder), max_len=512)
    arrays = [c for c in rows.columns if c.startswith(("input_ids", "attention_mask"))]
    return rows.select("row_id", *[joined(F.col(c)).alias(c) for c in arrays], "was_truncated", "split")


@query
def build_prompt_set(spark, folder):
    rows = build_prompts(inputs.exchanges(spark, folder), SYSTEM, inputs.vocabulary(spark, folder), max_len=256)
    return rows.select("row_id", joined(F.col("input_ids")).alias("input_ids"), "query", "was_truncated", "split")


# Streams


def _answered_turns(spark: SparkSession, folder: str, answer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """User turns read as a file stream, answered, scored by a batch model and stored."""
    # A pattern that fits one name only: a stream takes a single file no other way.
    turns = qs.question_stream(spark, f"{folder}/conversations.parque[t]", schemas.CONVERSATIONS)
    asked = turns.where("role = 'user'").select(
        derived.exchange_id(F.col("conv_id"), F.col("turn")).alias("row_id"), F.col("text").alias("question")
    )
    answered = qs.answered_stream(qs.open_prompts(asked, SYSTEM), answer, batch_score_udf(_spacing)("text"), SYSTEM)
    path = fresh_path(spark, "answered")
    qs.append_to(answered, path, f"{path}-progress").awaitTermination()
    return spark.read.parquet(path).select("row_id", "prompt", "response", places("score", 4))


@query
def stream_prompts(spark, folder):
    """Answers from the stored exchanges."""
    stored = inputs.exchanges(spark, folder).select("row_id", F.col("answer").alias("response"))
    return _answered_turns(spark, folder, qs.stored_answers(stored))


@query
def stream_generated(spark, folder):
    """Answers from the generator hook, for every user turn."""
    return _answered_turns(spark, folder, qs.generated_answers(_repeater, max_new=512))


# Replayed times begin a day after the epoch, where watermarks start.
FIRST_MS = 86_400_000


def _timed_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations with a time per turn, turn by turn; every fifth says the stop word in its third turn."""
    turns = derived.table(spark, folder, "conversations")
    says = (F.col("role") == "user") & (F.col("turn") == 2) & (F.col("conv_id") % 5 == 0)
    return turns.select(
        "conv_id", "turn", "role", F.when(says, " Exit\n").otherwise(F.col("text")).alias("text"),
        F.timestamp_millis(FIRST_MS + F.col("turn") * 1000 + F.col("conv_id") % 1000).alias("ts"),
    )


@query
def session_turns(spark, folder):
    """Turns before the stop word of their conversation."""
    return until_stop(_timed_turns(spark, folder).drop("ts"))


@query
def stream_sessions(spark, folder):
    """The same over a stream of several micro-batches, each with a later part of every conversation."""
    turns, source, path = _timed_turns(spark, folder), fresh_path(spark, "turns"), fresh_path(spark, "sessions")
    late = write_slices(turns, "ts", source, 4)
    arriving = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 2).parquet(source)
    kept = open_sessions(arriving, "ts", late, idle_ms=3_600_000)
    qs.append_to(kept, path, f"{path}-progress").awaitTermination()
    return spark.read.schema(turns.schema).parquet(path).drop("ts")


# How long an answer may take to count, and how long the slowest takes.
WAIT_MS, SLOWEST_MS = 45, 60


@query
def stream_joined_answers(spark, folder):
    """Questions and answers arriving as two streams; an answer may be late or missing."""
    turns = derived.table(spark, folder, "conversations").where("role = 'user'")
    key = derived.exchange_id(F.col("conv_id"), F.col("turn")).alias("row_id")
    asked = turns.select(key, F.col("text").alias("question"), F.timestamp_millis(FIRST_MS + F.col("conv_id") * 100 + F.col("turn")).alias("asked_at"))
    slow = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit("slow|"), F.col("row_id").cast("string"))), 1, 8), 16, 10).cast("bigint"), F.lit(SLOWEST_MS))
    given = inputs.exchanges(spark, folder).select(
        "row_id", F.col("answer").alias("response"), F.timestamp_millis(FIRST_MS + F.col("conv_id") * 100 + F.col("turn") + slow).alias("answered_at")
    )
    questions, answers, path = (fresh_path(spark, name) for name in ("asked", "given", "joined"))
    late = max((write_slices(df, time, place, 4) for df, time, place in ((asked, "asked_at", questions), (given, "answered_at", answers))), key=lambda w: int(w.split()[0]))
    # Both sources say that they are done, under keys that no row has.
    write_end(asked, "asked_at", questions, row_id=-1, question="")
    write_end(given, "answered_at", answers, row_id=-2)
    streams = [spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3).parquet(place) for df, place in ((asked, questions), (given, answers))]
    joined_up = qs.joined_answers(qs.open_prompts(streams[0], SYSTEM), streams[1], late, f"{WAIT_MS} milliseconds")
    scored = qs.scored_answers(joined_up, batch_score_udf(_spacing)("text"), SYSTEM)
    qs.append_to(scored, path, f"{path}-progress").awaitTermination()
    return spark.read.parquet(path).select("row_id", "prompt", "response", places("score", 4))


def _arriving_rollouts(spark: SparkSession, folder: str) -> tuple[DataFrame, str, str]:
    """Stored rollouts as a stream, a later part of the run in each batch of files; its path and lateness."""
    source = fresh_path(spark, "rollouts")
    rows = _rollouts(spark, folder).select("run_id", "step", "slot", "reward", F.timestamp_millis(FIRST_MS + F.col("step") * 1000 + F.col("slot")).alias("rollout_ts"))
    rows = written(rows, "replayed")
    late = write_slices(rows, "rollout_ts", source, 4)
    return rows, source, late


@query
def stream_step_rewards(spark, folder):
    """Stored rollouts replayed as a stream; the last state of every step, from a store that merges its files."""
    rows, source, _ = _arriving_rollouts(spark, folder)
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)
    store = sr.StepStore(spark, fresh_path(spark, "running"), every=2)
    store.keep(sr.running_rewards(arriving), fresh_path(spark, "running-progress")).awaitTermination()
    return _step_columns(store.read())


@query
def stream_step_rewards_bounded(spark, folder):
    """Every step once, when its rollouts are in or none can come any more; every seventh step lacks one."""
    rows, source, late = _arriving_rollouts(spark, folder)
    write_end(rows, "rollout_ts", source, step=-1)
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source).where("not (step % 7 = 0 and slot = 3) or rollout_ts is null")
    path = fresh_path(spark, "closed")
    qs.append_to(sr.closed_rewards(arriving, 8, late, idle_ms=60_000), path, f"{path}-progress").awaitTermination()
    return _step_columns(spark.read.parquet(path), "complete")
