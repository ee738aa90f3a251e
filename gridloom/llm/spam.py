"""Pages that are mostly keywords, links or tags: bagged trees on runs of a page, smoothed by the hosts' spam rates.

A page is cut into units: a sentence or line of some length is one, successive short pieces (`Fuse! Breaker sale.`, list
lines) are judged together as a run of about RUN_WORDS words, because a short piece alone says nothing. Clear units get weak
labels from rules; from them come word statistics over all pages and, on a bounded sample, bagged decision trees over
content and link features. The trees give every unit of every page a probability; the spam rates of a page's hosts move the
doubtful ones; a page's score is the share of its characters in units judged spam.

The texts are read once: what that pass writes (features, word buckets and sizes of the units) serves the word statistics,
the sample and the judging, which are array work.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.trees import BaggedTrees
from gridloom.operators.skew import salted_join
from gridloom.session import cut, drop, spread

#: Buckets that words are hashed to: the bound of the word statistics, whatever the vocabulary.
WORD_BUCKETS = 1 << 18
#: Labelled units that the trees are trained on at most, half of each label; drawn from all pages by a hash.
SAMPLE_UNITS = 40_000
#: A piece of at most SHORT words joins its neighbours until the run has RUN_WORDS words; a rest of under REST words joins the run before it.
SHORT, RUN_WORDS, REST = 7, 16, 8
#: Weight of the hosts' rates on the log odds of a unit, and the most that they move them; pages of average kind that each host is credited with.
PULL, PULL_MOST, PRIOR_PAGES = 0.3, 1.0, 20.0
#: From this share of characters on a page is spam; a page of fewer characters than LEAST_CHARS says nothing either way.
MOSTLY, LEAST_CHARS = 0.5, 40

WORD = re.compile(r"[^\W\d_]+")
LINK = re.compile(r"""<a\s[^>]*>|</a>|\[[^\]\n]*\]\((?:https?://|www\.)[^)\s]*\)|(?:https?://|www\.)[^\s<>"')\]]+""")
HOST = re.compile(r"""(?:https?://(?:www\.)?|www\.)([^\s/<>"')\]?#:]+)""")
TAG = re.compile(r"(?<!\S)(?:[#+]|@tag:|tag:)[\w-]+")
SEPARATORS = re.compile(r"[,;|·•/!?]|\s[-–*+>]\s|\.\s")
DIGITS, CAPITAL = "0123456789", re.compile(r"[A-ZÀ-Þ]")
PIECE = re.compile(r"(?<=[.!?])\s+")
END = re.compile(r"[.!?;:]\W*$")
#: Frequent function words of the languages in use.
FUNCTION_WORDS = frozenset(
    "the a an is are was were of and to on at it no we if with has had be been not but only so then than that which from by its our "
    "der die das den dem ist sind war waren und von am ein eine einen wurde wurden hat auf nicht aber nach kein keine es er sie wir ob dass weil "
    "het de een zijn was werd en van op er geen dat heeft naar niet bij dus nog "
    "le la les des du un une est sont était et dans pas aucun a été que qui sur il elle ne plus donc".split()
)
#: Features that a unit has by itself; the last three come from the word statistics.
OWN = ("function_words", "distinct", "pairs", "links", "tags", "digits", "end", "n_words", "piece_words", "with_function", "piece_distinct", "separators", "capitals")
FEATURES = (*OWN, "odds", "spam_words", "ham_words")
NO_LABEL = -1


class Piece:
    """A sentence or line: its words without links, and how much of it is links and tags."""

    __slots__ = ("text", "links", "tags", "words", "function")

    def __init__(self, text: str):
        self.text = bare = text
        self.links = self.tags = 0
        if "http" in text or "www." in text or "<a" in text:
            self.links = sum(len(m.group()) for m in LINK.finditer(text))
            bare = LINK.sub(" ", text)
        if "#" in text or "+" in text or "tag:" in text:
            self.tags = sum(len(m.group()) for m in TAG.finditer(bare))
        self.words = WORD.findall(bare.lower())
        self.function = sum(map(FUNCTION_WORDS.__contains__, self.words))

    @property
    def marked(self) -> bool:
        """Whether links and tags make up more than half of it."""
        return 2 * (self.links + self.tags) > len(self.text)


def units(text: str) -> Iterator[list[Piece]]:
    """The units of a text, each a list of pieces.

    Runs of short pieces go on over lines; they end at a blank line, at a longer piece and where links or tags begin or end.
    """
    run: list[Piece] = []
    last: list[Piece] | None = None  # a full run that the next rest may join
    n = 0
    for line in [*text.split("\n"), ""]:
        pieces = [Piece(p) for p in PIECE.split(line) if p.strip()]
        for p in pieces or [None]:
            short = p is not None and len(p.words) <= SHORT
            if not (short and (not run and not last or (run or last)[-1].marked == p.marked)):
                if run and last and n < REST:
                    last, run = last + run, []
                for u in (last, run, [p] if p is not None and not short else None):
                    if u:
                        yield u
                last, run, n = None, [], 0
            if short:
                run.append(p)
                n += len(p.words)
                if n >= RUN_WORDS:
                    if last:
                        yield last
                    last, run, n = run, [], 0


def describe(unit: list[Piece]) -> tuple[list[float], int, set[str], int]:
    """(own features, weak label or NO_LABEL, different words, characters) of a unit."""
    k, first = len(unit), unit[0]
    if k == 1:
        text, words, links, tags, hits = first.text, first.words, first.links, first.tags, first.function
        size = len(text)
        ends, with_function, kinds_of_piece = float(END.search(text) is not None), float(hits > 0), 1.0
    else:
        size = links = tags = hits = ended = having = 0
        words = []
        for p in unit:
            size += len(p.text)
            links += p.links
            tags += p.tags
            hits += p.function
            having += p.function > 0
            ended += END.search(p.text) is not None
            words += p.words
        text = " ".join([p.text for p in unit])
        ends, with_function, kinds_of_piece = ended / k, having / k, len({tuple(p.words) for p in unit}) / k
    kinds = set(words)
    n = len(words)
    per = n or 1
    links, tags = links / size, tags / size
    function, distinct = hits / per, len(kinds) / per
    pairs = len(set(zip(words, words[1:], strict=False))) / (n - 1) if n > 1 else 1.0
    digits = sum(map(text.count, DIGITS)) / size
    own = [function, distinct, pairs, links, tags, digits, ends, min(60.0, n), min(60.0, n / k), with_function, kinds_of_piece, len(SEPARATORS.findall(text)) / per, len(CAPITAL.findall(text)) / size]

    label = NO_LABEL
    if links >= 0.6 or tags >= 0.6:
        label = 1
    elif k == 1:
        if n >= 10 and distinct <= 0.4 or n >= 6 and function <= 0.1 and distinct <= 0.65 or n <= 8 and not function and not ends and digits:
            label = 1
        elif 5 <= n <= 60 and function >= 0.15 and distinct >= 0.7 and ends and not tags and links < 0.5:
            label = 0
    elif n >= REST:
        if function <= 0.1 and n / k <= 5:
            label = 1
        elif function >= 0.15 and with_function >= 0.8 and ends >= 0.8 and not tags and links < 0.5:
            label = 0
    return own, label, kinds, size


class Buckets(dict):
    """Bucket by word, hashed when a word is first seen."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = b = zlib.crc32(word.encode()) % WORD_BUCKETS
        return b


def _described(pages: DataFrame, host: str) -> DataFrame:
    """One row a page: doc_id, text_hash, hosts, and as flat lists the own features, labels, sizes and word buckets of its units."""
    rows = pages.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col(host).cast("string").alias("host"), "text")
    names = {"doc_id": rows.schema["doc_id"].dataType.simpleString(), "text_hash": "bigint", "hosts": "array<string>", "own": "array<float>", "label": "array<tinyint>", "size": "array<int>", "n_kinds": "array<int>", "kinds": "array<int>"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets()
        for b in batches:
            hosts, own, label, size, n_kinds, kinds = ([] for _ in range(6))
            ends: list[list[int]] = [[0], [0], [0]]
            for s, h in zip(b.column(3), b.column(2), strict=True):
                text = s.as_py() or ""
                for u in units(text):
                    f, y, words, chars = describe(u)
                    own += f
                    label.append(y)
                    size.append(chars)
                    n_kinds.append(len(words))
                    kinds += [bucket[w] for w in sorted(words)]
                for e, flat in zip(ends, (own, label, kinds), strict=True):
                    e.append(len(flat))
                linked = {m.lower() for m in HOST.findall(text)} if "http" in text or "www." in text else None
                hosts.append(sorted(linked) if linked else [f"={h.as_py()}"])
            at = [pa.array(e, pa.int32()) for e in ends]
            lists = [
                pa.array(hosts, pa.list_(pa.string())), pa.ListArray.from_arrays(at[0], pa.array(own, pa.float32())), pa.ListArray.from_arrays(at[1], pa.array(label, pa.int8())),
                pa.ListArray.from_arrays(at[1], pa.array(size, pa.int32())), pa.ListArray.from_arrays(at[1], pa.array(n_kinds, pa.int32())), pa.ListArray.from_arrays(at[2], pa.array(kinds, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists], names=list(names))

    return spread(rows).mapInArrow(run, ", ".join(f"{n} {t}" for n, t in names.items()))


def _flat(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)


def _statistics(described: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of spam to sentence of each word bucket, and the number of units of label 0 and 1, counted over all pages.

    A task hands on one row for each bucket that it has seen, so at most WORD_BUCKETS + 1 rows come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, WORD_BUCKETS + 1), dtype=np.int64)
        for b in batches:
            label = _flat(b, "label")
            of_word = np.repeat(label, _flat(b, "n_kinds"))
            for y in (0, 1):
                seen[y, :-1] += np.bincount(_flat(b, "kinds")[of_word == y], minlength=WORD_BUCKETS)
                seen[y, -1] += int((label == y).sum())
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])], names=["bucket", "ham", "spam"])

    rows = described.select("label", "n_kinds", "kinds").mapInArrow(run, "bucket bigint, ham bigint, spam bigint")
    counts = rows.groupBy("bucket").agg(F.sum("ham").alias("ham"), F.sum("spam").alias("spam")).toPandas()
    seen = np.zeros((2, WORD_BUCKETS + 1))
    seen[:, counts["bucket"].to_numpy(int)] = counts[["ham", "spam"]].to_numpy(float).T
    ham, spam = seen[:, :-1]
    odds = np.clip(np.log((spam + 0.5) / (spam.sum() + 1)) - np.log((ham + 0.5) / (ham.sum() + 1)), -6, 6)
    odds[(ham + spam) == 0] = 0
    return odds, seen[:, -1]


def _features(b: pa.RecordBatch, odds: np.ndarray) -> np.ndarray:
    """All features of a batch's units, one row each."""
    n_kinds, kinds = _flat(b, "n_kinds"), _flat(b, "kinds")
    own = _flat(b, "own").reshape(-1, len(OWN)).astype(float)
    of, end = odds[kinds], np.cumsum(n_kinds)
    per = np.maximum(n_kinds, 1)

    def mean(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(x, dtype=float)])
        return (total[end] - total[end - n_kinds]) / per

    return np.column_stack([own, mean(of), mean(of > 1), mean(of < -1)])


def _sample(described: DataFrame, odds_of, n_units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and weak labels of at most SAMPLE_UNITS units, drawn from those of all pages by a hash, half of each label."""
    half = SAMPLE_UNITS // 2
    # Somewhat more than half are asked for, so that chance leaves few too little; the rest is cut off below.
    keep = [min(1.0, 1.1 * half / max(1.0, n)) for n in n_units]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = _flat(b, "label")
            lengths = b.column(b.schema.get_field_index("label")).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            no = np.arange(len(label)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            page = np.repeat(b.column(b.schema.get_field_index("text_hash")).to_numpy(zero_copy_only=False), lengths)
            mix = (page.astype(np.uint64) + no.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
            mix = (mix ^ (mix >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(11)
            share = np.where(label == 1, keep[1], keep[0])
            take = (label != NO_LABEL) & (mix / 2.0**53 < share)
            if take.any():
                x = _features(b, odds_of.value)[take]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), pa.array(label[take].astype(np.int32)), pa.array(mix[take].astype(np.int64))], names=[*FEATURES, "label", "mix"])

    got = described.mapInArrow(run, ", ".join(f"{f} double" for f in FEATURES) + ", label int, mix bigint").toPandas()
    got = got.sort_values(["mix", *FEATURES]).groupby("label").head(half)
    return got[list(FEATURES)].to_numpy(float), got["label"].to_numpy(int)


def page_scores(pages: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, score, smoothed, n_chars): the share of a page's characters in spam units, by the trees alone and with the hosts' rates.

    pages: doc_id, text and the column `host`, to which a page without links counts; a page with links counts to the hosts
    that it links to; other columns are ignored. Null and blank texts score 0. A doc_id delivered again with the same text
    comes out once; with different texts once for each. Without labelled units of both kinds nothing can be learned and all
    scores are 0. The log odds of a unit move by PULL times those of its page's hosts (mean over them) above those of all
    pages, by PULL_MOST at most.
    """
    spark = pages.sparkSession
    described = cut(_described(pages, host))
    odds, n_units = _statistics(described)
    odds_of = spark.sparkContext.broadcast(odds)  # WORD_BUCKETS doubles: 2 MB
    x, y = _sample(described, odds_of, n_units)
    model_of = spark.sparkContext.broadcast(BaggedTrees().fit(x, y) if 0 < y.sum() < len(y) else None)
    most = 1 / (1 + math.exp(-PULL_MOST))  # beyond this probability, or below 1 - most, no host changes the verdict

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = _flat(b, "size").astype(np.int64)
            p = model_of.value.predict(_features(b, odds_of.value)) if model_of.value is not None and len(size) else np.zeros(len(size))
            lengths = b.column(b.schema.get_field_index("size")).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            page = np.repeat(np.arange(b.num_rows), lengths)

            def chars(which: np.ndarray) -> pa.Array:
                return pa.array(np.bincount(page[which], size[which], b.num_rows).astype(np.int64))

            open_ = (p > 1 - most) & (p <= most)
            at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(page[open_], minlength=b.num_rows))]).astype(np.int32))
            doubt = pa.StructArray.from_arrays([pa.array(np.log(p[open_] / (1 - p[open_]))), pa.array(size[open_])], ["odds", "size"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), chars(np.ones(len(size), bool)), chars(p > 0.5), chars(p > most), pa.ListArray.from_arrays(at, doubt)], names=["doc_id", "text_hash", "hosts", "n_chars", "spam", "sure", "doubt"]
            )

    kind = described.schema["doc_id"].dataType.simpleString()
    judged = described.mapInArrow(run, f"doc_id {kind}, text_hash bigint, hosts array<string>, n_chars bigint, spam bigint, sure bigint, doubt array<struct<odds:double,size:bigint>>")
    judged = judged.groupBy("doc_id", "text_hash").agg(*(F.first(c).alias(c) for c in ("hosts", "n_chars", "spam", "sure", "doubt")))
    judged = cut(judged.withColumn("score", F.coalesce(F.try_divide("spam", "n_chars"), F.lit(0.0))))
    drop(described)

    spam = (F.col("score") > MOSTLY).cast("double")
    mean = judged.agg(F.coalesce(F.avg(spam), F.lit(0.0)).alias("m")).first().m
    credit = mean * PRIOR_PAGES
    open_pages = judged.filter(F.size("doubt") > 0)
    rates = judged.select(F.explode("hosts").alias("host"), spam.alias("spam")).groupBy("host").agg(((F.sum("spam") + credit) / (F.count(F.lit(1)) + PRIOR_PAGES)).alias("rate"))
    log_odds = lambda r: F.log((r + 1e-6) / (1 - r + 1e-6))
    visits = open_pages.select("doc_id", "text_hash", F.explode("hosts").alias("host"))
    pull = salted_join(visits, rates, ["host"]).groupBy("doc_id", "text_hash").agg(F.avg(log_odds(F.col("rate")) - log_odds(F.lit(mean))).alias("pull"))
    pull = pull.withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"}).withColumn("pull", F.least(F.greatest(PULL * F.col("pull"), F.lit(-PULL_MOST)), F.lit(PULL_MOST)))
    same = judged["doc_id"].eqNullSafe(pull["_d"]) & judged["text_hash"].eqNullSafe(pull["_h"])
    moved = F.aggregate("doubt", F.lit(0).cast("bigint"), lambda acc, u: acc + F.when(u["odds"] + F.coalesce("pull", F.lit(0.0)) > 0, u["size"]).otherwise(0))
    return judged.join(pull, same, "left").select("doc_id", "score", F.coalesce(F.try_divide(F.col("sure") + moved, F.col("n_chars")), F.lit(0.0)).alias("smoothed"), "n_chars")


def spam_pages(pages: DataFrame, host: str = "source") -> DataFrame:
    """doc_id of every page that is mostly spam; a page of fewer than LEAST_CHARS characters never is."""
    return page_scores(pages, host).filter((F.col("smoothed") > MOSTLY) & (F.col("n_chars") >= LEAST_CHARS)).select("doc_id").distinct()
