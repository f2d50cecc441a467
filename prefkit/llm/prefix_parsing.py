"""Removal of repeated byte strings by parsing texts into phrases.

Every string of ``span`` bytes has a trigger: of the rolling hashes of its
``gram``-byte pieces, the leftmost smallest one. (Triggers by a residue of the
hash can miss a string; a minimum cannot.) Strings that start next to each
other mostly share their trigger, and such a run with the bytes it reads is
a phrase. Equal strings have equal triggers at equal places, so they only need
to be looked for among phrases of one trigger:

1. Parse: each text becomes a list of phrases, each known by the hash of its
   trigger and of its content. Phrases that occur twice in a batch keep their
   first place only; the other places are removed there and then.
2. Phrases meet by trigger. Equal phrases: all places but the first are removed.
   Where a trigger has several different phrases, their bytes form a dictionary.
3. The suffixes of the dictionary are ranked by their first ``span`` bytes,
   doubling the depth from 8 bytes on, as a suffix array is built. Suffixes of
   equal rank, in the order of the parse (doc_id, place), are equal strings;
   all but the first are removed. No rank of parse suffixes is needed, since a
   phrase holds the ``span - 1`` bytes that follow its last start.

Copies are thus dropped as whole phrases, and bytes are read again only at the
edges of repeated passages. Phrases are joined in batches, one binary row per
batch and bucket of triggers; a passage that all texts share gives one entry
per batch.

Cases: null and empty texts and texts shorter than a span lose nothing; a null
doc_id comes first; rows of one doc_id do not make each other's strings
earlier unless the start is smaller, so repeated rows get equal results; an
empty table gives an empty one; other columns are ignored. Matches never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from prefkit.llm.common import map_slices, stored

SPAN, GRAM = 100, 40
# Bytes parsed at once; bytes of text per bucket of triggers; dictionary phrases per bucket.
BATCH_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
# Bytes of text of the documents whose places are put together at once.
PART_BYTES = 16 << 20
BUCKET_PHRASES = 8_000
LOWEST = -(2**63)

_RANDOM = np.random.default_rng(7)
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1

PHRASE = np.dtype([("gram", "<u8"), ("phrase", "<u8"), ("doc", "<i8"), ("lo", "<u4"), ("th", "<u4"), ("rel", "u1"), ("n", "u1")])
PLACE = np.dtype([("gram", "<u8"), ("doc", "<i8"), ("th", "<u4"), ("lo", "<u4"), ("n", "u1")])
FOUND = "part long, later binary, asked binary"
DOCUMENTS = "doc long, th long, places array<long>, grams array<long>, los array<long>, ns array<int>"

_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BATCH_BYTES + (64 << 10))
        tables = []
        for base in (BASE, pow(BASE, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def parse(units: list[tuple[int, int, int, bytes]], span: int = SPAN, gram: int = GRAM) -> np.ndarray:
    """``PHRASE`` records of (doc, text hash, offset, bytes) units, in order."""
    units = [u for u in units if len(u[3]) >= span]
    if not units:
        return np.empty(0, PHRASE)
    data = np.frombuffer(b"".join(u[3] for u in units), np.uint8)
    sizes = np.array([len(u[3]) for u in units])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers[: len(data)], out=sums[1:])
    grams = _mixed((sums[gram:] - sums[:-gram]) * inverses[: len(data) - gram + 1])
    # Hash above, place below: the minimum is the leftmost smallest hash.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, reach = 1, span - gram + 1
    while width < reach:
        step = min(width, reach - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    trigger = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)

    inside = np.zeros(len(trigger) + 1, np.int8)
    np.add.at(inside, begins, 1)
    np.add.at(inside, np.minimum(ends - span + 1, len(trigger)), -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    opens = np.empty(len(trigger), bool)
    opens[0] = True
    np.not_equal(trigger[1:], trigger[:-1], out=opens[1:])
    opens[begins] = True
    starts = np.flatnonzero(opens & inside)
    unit = np.searchsorted(ends, starts, side="right")
    stops = np.minimum(np.append(starts[1:], len(trigger)), ends[unit] - span + 1)

    out = np.empty(len(starts), PHRASE)
    out["n"], out["rel"] = stops - starts, trigger[starts] - starts
    out["gram"] = grams[trigger[starts]]
    shape = out["n"].astype(np.uint64) * np.uint64(256) + out["rel"]
    out["phrase"] = _mixed((sums[stops + span - 1] - sums[starts]) * inverses[starts] + _mixed(shape))
    info = np.array([(u[0], u[1], u[2]) for u in units], np.int64)
    out["doc"], out["th"] = info[unit, 0], info[unit, 1]
    out["lo"] = starts - begins[unit] + info[unit, 2]
    return out


def first_places(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each phrase, places with an earlier one), both as records."""
    found = found[np.lexsort((found["lo"], found["doc"], found["phrase"], found["gram"]))]
    same = np.zeros(len(found), bool)
    same[1:] = (found["gram"][1:] == found["gram"][:-1]) & (found["phrase"][1:] == found["phrase"][:-1])
    first = np.flatnonzero(~same)[np.cumsum(~same) - 1]
    later = same & ((found["doc"] != found["doc"][first]) | (found["lo"] != found["lo"][first]))
    return found[~same], found[later]


def _placed(found: np.ndarray) -> np.ndarray:
    """``PLACE`` records of ``PHRASE`` records."""
    out = np.empty(len(found), PLACE)
    for name in PLACE.names:
        out[name] = found[name]
    return out


def _parts(found: np.ndarray, parts: int) -> np.ndarray:
    """The part of the documents that each place belongs to."""
    h = _mixed(found["doc"].view(np.uint64) * np.uint64(BASE) + found["th"]) if len(found) else np.empty(0, np.uint64)
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _split(found: np.ndarray, part: np.ndarray) -> dict[int, bytes]:
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    pieces = np.split(found[order], cuts) if len(found) else []
    return {int(part[order[at]]): piece.tobytes() for at, piece in zip(np.append(0, cuts), pieces, strict=bool(len(found)))}


def parse_texts(keyed: DataFrame, buckets: int, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(bucket, phrases): packed records; bucket -1 holds places already known to be later ones."""

    def packed(units: list[tuple[int, int, int, bytes]]) -> pd.DataFrame:
        first, later = first_places(parse(units, span, gram))
        # Triggers are smallest hashes, so they are small themselves; hashed once more they fill the buckets evenly.
        bucket = ((_mixed(first["gram"] * np.uint64(BASE)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        first, bucket = first[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        parts = np.split(first, cuts) if len(first) else []
        rows = [(int(bucket[i]), p.tobytes()) for i, p in zip(np.append(0, cuts), parts, strict=bool(len(first)))]
        return pd.DataFrame([*rows, (-1, later.tobytes())], columns=["bucket", "phrases"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units, held = [], 0
        for batch in batches:
            for doc, th, data in zip(batch["doc"], batch["th"], batch["data"], strict=True):
                for at in range(0, max(len(data) - span + 1, 1), BATCH_BYTES):
                    units.append((doc, th, at, data[at : at + BATCH_BYTES + span - 1]))
                    held += len(units[-1][3])
                    if held >= BATCH_BYTES:
                        yield packed(units)
                        units, held = [], 0
        if units:
            yield packed(units)

    return map_slices(keyed, run, "bucket long, phrases binary")


def _meet(parts: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Packed by part: later places of equal phrases, and first places of phrases whose trigger has several."""
        found = np.concatenate([np.frombuffer(p, PHRASE) for p in rows["phrases"]])
        if key[0] < 0:
            later, many = found, found[:0]
        else:
            first, later = first_places(found)
            same = np.zeros(len(first) + 1, bool)
            same[1:-1] = first["gram"][1:] == first["gram"][:-1]
            many = first[same[1:] | same[:-1]]
        later, many = _placed(later), _placed(many)
        one, other = _split(later, _parts(later, parts)), _split(many, _parts(many, parts))
        return pd.DataFrame([(p, one.get(p), other.get(p)) for p in sorted(one.keys() | other.keys())], columns=["part", "later", "asked"])

    return run


def _by_document(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The places of each document of a part: later ones packed as lo * 256 + n, and phrases to compare."""
    out = []
    for name in ("later", "asked"):
        packed = [p for p in rows[name] if p is not None]
        found = np.frombuffer(b"".join(packed), PLACE)
        found = found[np.lexsort((found["lo"], found["th"], found["doc"]))]
        cuts = np.flatnonzero((np.diff(found["doc"]) != 0) | (np.diff(found["th"].astype(np.int64)) != 0)) + 1
        for piece in np.split(found, cuts) if len(found) else []:
            mine = (int(piece["doc"][0]), int(piece["th"][0]))
            if name == "later":
                out.append((*mine, (piece["lo"].astype(np.int64) << 8) + piece["n"], None, None, None))
            else:
                out.append((*mine, None, piece["gram"].astype(np.int64), piece["lo"].astype(np.int64), piece["n"].astype(np.int32)))
    return pd.DataFrame(out, columns=[c.split()[0] for c in DOCUMENTS.split(", ")])


def dictionary_ranks(data: np.ndarray, starts: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Ranks of the ``span``-byte strings at ``starts``: equal for equal strings, in the order of their bytes."""
    padded = np.concatenate([data, np.zeros(2 * span, np.uint8)])
    rank = np.zeros(len(padded) - 7, np.uint64)
    for i in range(8):
        rank = (rank << np.uint64(8)) | padded[i : i + len(rank)]
    depth = 8
    _, rank = np.unique(rank, return_inverse=True)
    while 2 * depth <= span:
        n = len(rank) - depth
        _, rank = np.unique(rank[:n] * len(padded) + rank[depth:], return_inverse=True)
        depth *= 2
    _, rank = np.unique(rank[starts] * len(padded) + rank[starts + span - depth], return_inverse=True)
    return rank


def _compare(span: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Places (doc, th, lo, n) of dictionary strings that also start earlier."""
        n = rows["n"].to_numpy(np.int64)
        sizes = n + span - 1
        begins = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(rows["data"]), np.uint8)
        owner = np.repeat(np.arange(len(rows)), n)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        rank = dictionary_ranks(data, begins[owner] + inner, span)
        doc, place = rows["doc"].to_numpy(np.int64)[owner], rows["lo"].to_numpy(np.int64)[owner] + inner
        order = np.lexsort((place, doc, rank))
        same = np.zeros(len(order), bool)
        same[1:] = rank[order][1:] == rank[order][:-1]
        first = order[~same][np.cumsum(~same) - 1]
        again = np.zeros(len(order), bool)
        again[order] = (doc[order] != doc[first]) | (place[order] != place[first])
        # Runs of later places inside one phrase become one row.
        opens = again.copy()
        opens[1:] &= ~again[:-1] | (owner[1:] != owner[:-1])
        at = np.flatnonzero(opens)
        run_of = np.cumsum(opens)[again] - 1
        return pd.DataFrame(
            {
                "doc": doc[at],
                "th": rows["th"].to_numpy(np.int64)[owner[at]],
                "lo": place[at],
                "n": np.bincount(run_of, minlength=len(at)).astype(np.int32),
            }
        )

    return run


def _cut_phrases(span: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, th, data, grams, los, ns in zip(*[batch[c] for c in ("doc", "th", "data", "grams", "los", "ns")], strict=True):
                rows += [(doc, th, g, lo, n, data[lo : lo + n + span - 1]) for g, lo, n in zip(grams.tolist(), los.tolist(), ns.tolist(), strict=True)]
            yield pd.DataFrame(rows, columns=["doc", "th", "gram", "lo", "n", "data"])

    return run


def covered(places: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Merged (begins, ends) of the bytes that packed places (lo * 256 + n) cover."""
    places = np.sort(np.asarray(places, np.int64))
    begins, ends = places >> 8, np.maximum.accumulate((places >> 8) + (places & 255) + span - 1)
    opens = np.ones(len(places), bool)
    opens[1:] = begins[1:] > ends[:-1]
    return begins[opens], ends[np.append(np.flatnonzero(opens)[1:] - 1, len(places) - 1)] if len(places) else ends


def _keep(span: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, data, places in zip(batch["doc"], batch["data"], batch["places"], strict=True):
                if places is None or not len(places):
                    rows.append((doc, len(data), data, [], []))
                    continue
                begins, ends = covered(places, span)
                edges = [0, *np.column_stack([begins, ends]).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((doc, len(data), kept, begins, ends))
            yield pd.DataFrame(rows, columns=["doc", "n_bytes", "kept", "begins", "ends"])

    return run


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, kept (bytes), begins and ends of the removed runs, of every document."""
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST))
    data = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    keyed = docs.select(doc.alias("doc"), F.crc32(data).alias("th"), data.alias("data"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, total // BUCKET_BYTES)
    parsed = parse_texts(keyed, buckets, span, gram)
    # Known later places lie in rows of bucket -1, one per batch; they are spread by their bytes.
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("phrases"), F.lit(buckets))).otherwise(F.col("bucket"))
    parts = max(16, total // PART_BYTES)
    met = parsed.groupBy(spread.alias("bucket")).applyInPandas(_meet(parts), FOUND)
    # A document's places stay packed until they are put together, in one row for either kind.
    met = stored(met.groupBy("part").applyInPandas(_by_document, DOCUMENTS), "phrases")

    wanted = met.where("grams is not null").select("doc", "th", "grams", "los", "ns")
    groups = max(1, (wanted.agg(F.sum(F.size("grams"))).first()[0] or 0) // BUCKET_PHRASES)
    # This join and the last one read the texts in one layout, so they move once.
    phrases = keyed.join(wanted, ["doc", "th"]).select("doc", "th", "data", "grams", "los", "ns")
    cut = map_slices(phrases, _cut_phrases(span), "doc long, th long, gram long, lo long, n int, data binary")
    edges = cut.groupBy(F.pmod("gram", F.lit(groups)).alias("_group")).applyInPandas(_compare(span), "doc long, th long, lo long, n int")
    edges = edges.groupBy("doc", "th").agg(F.collect_list(F.shiftleft("lo", 8) + F.col("n")).alias("places"))
    later = met.where("places is not null").select("doc", "th", "places").unionByName(edges)
    places = later.groupBy("doc", "th").agg(F.flatten(F.collect_list("places")).alias("places"))
    kept = keyed.join(places, ["doc", "th"], "left").select("doc", "data", "places")
    kept = map_slices(kept, _keep(span), "doc long, n_bytes long, kept binary, begins array<long>, ends array<long>")
    return kept.select(F.nullif("doc", F.lit(LOWEST)).alias("doc_id"), "n_bytes", "kept", "begins", "ends")


def removed_digests(docs: DataFrame) -> DataFrame:
    rows = remove_repeats(docs)
    return rows.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("begins").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
