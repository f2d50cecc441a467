"""Secret scans with multipart credential linking.

Three base kinds of spans are reported wherever they occur: ``assign`` (a password, token or key given
a value), ``access`` (an access identifier) and ``hex`` (a long run of hex digits). Three weak kinds are
too common to report alone: ``login`` (a user, account or client given a value), ``token`` (a long run that
mixes capitals, small letters and digits) and ``url`` (an address of a service). access and login identify,
assign, hex and token are secret, a url is an endpoint. A weak span is reported when its
complement lies in its scope, at most ``SCOPE`` code points away: for a login a secret, for a token an identifier, for a
url both. Weak spans that overlap a base span are part of it and are dropped; parts that overlap
do not complement each other.

Base spans stay in their row: a text split at its matches gives the lengths between
them, and running sums of lengths give places. Only rows that hold a weak span, an identifier and a secret go on to
two interval joins, on equal bins of ``SCOPE`` code points that spans and scopes are dealt to. A bin
holds a bounded number of spans, since spans of one kind do not overlap, so no join lists all pairs of a text.

Cases: a null text counts as empty and has no spans; repeated rows get repeated results; rows of one doc_id are
told apart by their text; a null doc_id is kept; an empty table gives an empty one; other columns are ignored;
texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from prefkit.llm.common import stored, texts_of

SCOPE = 200
STEPS = 256


def either(pattern: str) -> str:
    """The pattern with every ASCII letter in either case; spelled out because engines fold other letters differently."""
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.isalpha() else c for c in pattern)


_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
# Kinds in their order with pattern, group to measure and its least length.
KINDS: dict[str, tuple[str, int, int]] = {
    "assign": (f"({either('password|passwd|secret|token|api_?key')}){_GIVEN}([A-Za-z0-9+/_.=-]+)", 2, 6),
    # Of a run of these characters the first match takes all, so a least length in the pattern drops the same matches.
    "access": ("AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
    "login": (f"({either('username|userid|user_id|user|login|account|client_?id')}){_GIVEN}([A-Za-z0-9+/_.@-]+)", 2, 3),
    "token": ("[A-Za-z0-9+/_=-]{16,}", 0, 16),
    "url": ("(https?|ftp|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+", 0, 1),
}
BASE, WEAK = ("assign", "access", "hex"), ("login", "token", "url")
IDENTIFIERS, SECRETS = ("access", "login"), ("assign", "hex", "token")
NUMBERS = {kind: n for n, kind in enumerate(KINDS)}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` reads it."""
    return F.transform(F.array(value), body)[0]


def _sums(numbers: Column, start: Column) -> Column:
    """Running sums of a short array."""
    empty = F.array().cast("array<bigint>")
    step = lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["out"], F.array(acc["s"] + x)).alias("out"))
    return F.aggregate(numbers, F.struct(start.alias("s"), empty.alias("out")), step, lambda acc: acc["out"])


def running_sums(numbers: Column) -> Column:
    """Running sums of an array of bigint, ``STEPS`` at a time, so that long arrays are not copied for each number."""
    zero = F.lit(0).cast("bigint")

    def summed(all_numbers: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_numbers), F.lit(STEPS))
        parts = F.transform(starts, lambda at: F.slice(all_numbers, at, F.lit(STEPS)))

        def placed(blocks: Column) -> Column:
            totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, x: s + x))
            before = F.concat(F.array(zero), _sums(totals, zero))
            return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), _sums))

        return _let(parts, placed)

    return _let(numbers, lambda n: F.when(F.size(n) > 0, summed(n)).otherwise(F.array().cast("array<bigint>")))


def _mixed(token: Column) -> Column:
    return token.rlike("[0-9]") & token.rlike("[a-z]") & token.rlike("[A-Z]")


def spans_of(text: Column, kind: str) -> Column:
    """array<struct<start, no, end, value>> of a kind's matches, in code points; no is the kind's number."""
    pattern, group, least = KINDS[kind]
    # Matches have a length, so splitting at them keeps one piece before each and one behind the last.
    found = F.struct(
        F.split(text, pattern, -1).alias("pieces"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.array().cast("array<string>")).alias("values"),
    )

    def spans(f: Column) -> Column:
        hits = f["hits"]
        steps = F.zip_with(F.slice(f["pieces"], F.lit(1), F.size(hits)), hits, lambda p, h: (F.length(p) + F.length(h)).cast("bigint"))
        made = F.zip_with(
            running_sums(steps),
            F.arrays_zip(hits.alias("hit"), (f["values"] if group else hits).alias("of")),
            lambda end, h: F.struct(
                (end - F.length(h["hit"])).alias("start"),
                F.lit(NUMBERS[kind]).alias("no"),
                end.alias("end"),
                h["hit"].alias("value"),
                F.length(h["of"]).alias("size"),
            ),
        )
        right = F.filter(made, lambda s: (s["size"] >= least) & (_mixed(s["value"]) if kind == "token" else F.lit(True)))
        return F.transform(right, lambda s: F.struct(s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"), s["value"].alias("value")))

    # Most texts have no match: one search settles them.
    empty = F.array().cast("array<struct<start:bigint,no:int,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), _let(found, spans)).otherwise(empty)


def _is(number: Column, kinds: tuple[str, ...]) -> Column:
    return number.isin([NUMBERS[k] for k in kinds])


def _bins(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / SCOPE), F.floor(end / SCOPE)))


def linked(spans: DataFrame) -> DataFrame:
    """(key, start, no, end, value): the weak ones of (key, start, no, end, value) whose complement lies in their scope."""
    here, last = F.col("start"), F.greatest(F.col("end") - 1, F.col("start"))
    weak = spans.where(_is(F.col("no"), WEAK))
    strong = spans.where(_is(F.col("no"), BASE)).select("key", F.col("start").alias("b_start"), F.col("end").alias("b_end"), _bins(here, last).alias("bin"))
    covered = weak.select("key", "start", "no", "end", _bins(here, last).alias("bin")).join(strong, ["key", "bin"])
    covered = covered.where("start < b_end and b_start < end").select("key", "start", "no").distinct()
    free = weak.join(covered, ["key", "start", "no"], "left_anti")

    parts = spans.where(_is(F.col("no"), BASE)).unionByName(free).where(_is(F.col("no"), IDENTIFIERS + SECRETS))
    parts = parts.select(
        "key", F.col("start").alias("p_start"), F.col("end").alias("p_end"), _is(F.col("no"), IDENTIFIERS).alias("identifies"), _bins(here, last).alias("bin")
    )
    scopes = free.select("*", _bins(here - SCOPE, last + SCOPE).alias("bin"))
    met = scopes.join(parts, ["key", "bin"]).where(f"(p_end <= start and start - p_end <= {SCOPE}) or (end <= p_start and p_start - end <= {SCOPE})")
    seen = met.groupBy("key", "start", "no", "end", "value").agg(
        F.max("identifies").alias("identifier"), F.max(~F.col("identifies")).alias("secret")
    )
    complete = F.when(F.col("no") == NUMBERS["login"], F.col("secret"))
    complete = complete.when(F.col("no") == NUMBERS["token"], F.col("identifier")).otherwise(F.col("secret") & F.col("identifier"))
    return seen.where(complete).select("key", "start", "no", "end", "value")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans: array<struct<start, no, end, value>> in the order of their starts, then kinds.

    ``base`` holds the base spans, ``spans`` these and the linked weak ones.
    """
    texts = texts_of(docs)
    name = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("text")))
    found = texts.select("doc_id", name.alias("key"), *[spans_of(F.col("text"), kind).alias(kind) for kind in KINDS])
    found = stored(found, "secrets")
    base = F.array_sort(F.concat(*BASE))
    has = lambda kinds: reduce(lambda a, b: a | b, [F.size(k) > 0 for k in kinds])
    joins = has(WEAK) & has(IDENTIFIERS) & has(SECRETS)

    alone = found.where(~joins).select("doc_id", base.alias("base"), base.alias("spans"))
    # Equal rows of one document are linked once and counted.
    several = found.where(joins).select("doc_id", "key", base.alias("base"), F.concat(*WEAK).alias("weak"))
    several = several.groupBy("key").agg(*[F.first(c).alias(c) for c in ("doc_id", "base", "weak")], F.count(F.lit(1)).cast("int").alias("copies"))
    spans = several.select("key", F.inline(F.concat("base", "weak")))
    more = linked(spans).groupBy("key").agg(F.collect_list(F.struct("start", "no", "end", "value")).alias("more"))
    both = several.join(more, "key", "left")
    everything = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    both = both.select("doc_id", "base", everything.alias("spans"), F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_copy"))
    return alone.unionByName(both.drop("_copy"))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_rows(docs: DataFrame) -> DataFrame:
    """One row per span: doc_id, kind, start, end, value."""
    names = F.array(*[F.lit(k) for k in KINDS])
    rows = find_secrets(docs).select("doc_id", F.inline("spans"))
    return rows.select("doc_id", F.get(names, F.col("no")).alias("kind"), "start", "end", "value")


def _equal(number: int) -> Callable[[Column], Column]:
    return lambda value: value == number


def secret_digests(docs: DataFrame) -> DataFrame:
    """Counts, a hash of the base spans and all spans of every document."""
    kinds = F.transform("base", lambda s: s["no"])
    counts = [F.size(F.filter(kinds, _equal(NUMBERS[k]))).cast("bigint").alias(f"n_{k}") for k in BASE]
    return find_secrets(docs).select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
