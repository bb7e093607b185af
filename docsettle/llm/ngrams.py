"""Perplexity of texts under an interpolated modified Kneser-Ney model of trusted text.

The model is over ``SYMBOLS`` symbols, in which every text is written without loss: the most
frequent characters are one symbol each, a capital is a mark and its small letter, any other
character a mark and its number among the others. No character is taken for another. The n-grams of
``ORDER`` symbols are counted over every trusted text; continuation counts, discounts and back-off
weights come from joins of the count tables, which are sharded by context or by suffix. The model
grows with the trusted text and stays in these tables: no process holds it. The different n-grams
of a group of texts, counted once in each group, are joined to them, from the shortest order up, and
the texts of a group are scored with what was found for its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from docsettle.llm.components import slices
from docsettle.session import settled, staged

SYMBOLS, ORDER = 64, 5
_BITS = 6
_START, _OTHER, _CAPITAL = 0, 1, 2
_DIGITS = SYMBOLS - 3  # numbers are written in the symbols that are no marks
_AT_ONCE = 1_000_000  # characters whose n-grams a task has in memory, if no text is longer
#: Bytes of text in a group. A task holds the different n-grams of one, which are far fewer than its characters.
GROUP_BYTES = 32_000_000
_LENGTH = 48  # a character's symbols are six bits each, the last one lowest; from this bit on stands how many


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _spelling(symbols: list[int]) -> int:
    return len(symbols) << _LENGTH | sum(x << _BITS * k for k, x in enumerate(reversed(symbols)))


def _small(point: int) -> int | None:
    """The small letter that, with the mark, stands for a capital and no other character."""
    small = chr(point).lower()
    return ord(small) if chr(point).isupper() and len(small) == 1 and small.upper() == chr(point) else None


def alphabet(documents: DataFrame) -> np.ndarray:
    """The symbols of each code point (``_LENGTH``), by character counts over all texts (column ``text``).

    Others are numbered in the order of code points, with as many digits for each as the last one needs, so characters of a script
    mostly share the leading digits. All characters that no text has share one more number.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                texts = batch.column(0).slice(begin, 1000).drop_null().to_pylist()
                total += np.bincount(_points("".join(texts)), minlength=0x110000)
        at = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["point", "n"])

    # as many rows as there are code points at most
    rows = documents.select("text").mapInArrow(count, "point long, n long").groupBy("point").agg(F.sum("n").alias("n")).collect()
    capitals = {r["point"]: small for r in rows if (small := _small(r["point"])) is not None}
    counts = {small: 0 for small in capitals.values()}  # a small letter may stand in no text
    counts |= {r["point"]: r["n"] for r in rows if r["point"] not in capitals}
    ordered = sorted(counts, key=lambda point: (-counts[point], point))
    spelled = {point: [k + 3] for k, point in enumerate(ordered[:_DIGITS])}
    others = sorted(ordered[_DIGITS:])
    size = 1
    while _DIGITS**size <= len(others):
        size += 1

    def numbered(k: int) -> list[int]:
        return [_OTHER, *(k // _DIGITS**d % _DIGITS + 3 for d in reversed(range(size)))]

    spelled |= {point: numbered(k) for k, point in enumerate(others)}
    spelled |= {point: [_CAPITAL, *spelled[small]] for point, small in capitals.items()}
    classes = np.full(0x110000, _spelling(numbered(len(others))), np.int64)
    for point, symbols in spelled.items():
        classes[point] = _spelling(symbols)
    return classes


def symbols_of(text: str, classes: np.ndarray) -> np.ndarray:
    """The text in symbols."""
    found = classes[_points(text)]
    size = found >> _LENGTH
    whole = np.repeat(found, size)
    left = np.repeat(np.cumsum(size), size) - np.arange(1, len(whole) + 1)  # symbols that follow of the same character
    return whole >> _BITS * left & SYMBOLS - 1


def codes_of(text: str, classes: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each symbol of the text, as one number; the start of a text is a symbol."""
    s = np.concatenate((np.full(ORDER - 1, _START, np.int64), symbols_of(text, classes)))
    code = np.zeros(len(s) - ORDER + 1, np.int64)
    for i in range(ORDER):
        code = code << _BITS | s[i : len(s) - ORDER + 1 + i]
    return code


def _portions(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """The texts that are not empty, in lists of about ``_AT_ONCE`` characters."""
    some: list[str] = []
    size = 0
    for text in texts:
        if text:
            some.append(text)
            size += len(text)
        if size >= _AT_ONCE:
            yield some
            some, size = [], 0
    if some:
        yield some


def _shorter(code: str, order: int) -> Column:
    """The last ``order`` symbols of an n-gram."""
    return F.col(code).bitwiseAND(F.lit((1 << _BITS * order) - 1))


def _context(code: str) -> Column:
    return F.shiftrightunsigned(code, _BITS)


def ngram_counts(trusted: DataFrame, classes) -> DataFrame:
    """``code, n`` over all texts (column ``text``); counts are added up in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _portions(text for part in slices(batches) for text in part.column(0).to_pylist()):
            codes, n = pc.value_counts(pa.array(np.concatenate([codes_of(text, classes.value) for text in some]))).flatten()
            for begin in range(0, len(codes), 100_000):
                yield pa.RecordBatch.from_arrays([codes.slice(begin, 100_000), n.slice(begin, 100_000)], ["code", "n"])

    return trusted.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> list[dict[str, DataFrame]]:
    """For each order, longest last: seen n-grams with their own share (``own``: code, share), and back-off weights of contexts (``weights``: context, weight).

    Below the longest order an n-gram's count is the number of different symbols before it.
    Discounts are the three of modified Kneser-Ney, from how many n-grams occur once to four
    times. All of it are tables, however many n-grams there are.
    """
    orders: list[dict[str, DataFrame]] = []
    table = staged(counts, "ngrams")
    for order in range(ORDER, 0, -1):
        seen = dict(table.where("n <= 4").groupBy("n").count().collect())
        n1, n2, n3, n4 = (seen.get(k, 0) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
        discounts = [
            min(max(k - (k + 1) * y * b / a, 0.05), k - 0.05) if a and b else 0.5 * k
            for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))
        ]
        cut = F.when(F.col("n") == 1, discounts[0]).when(F.col("n") == 2, discounts[1]).otherwise(discounts[2])
        shares = table.select(F.col("code"), _context("code").alias("context"), "n", cut.alias("cut"))
        totals = shares.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("lost"))
        own = shares.join(totals, "context").select("code", ((F.col("n") - F.col("cut")) / F.col("total")).alias("share"))
        orders.append({"own": own, "weights": totals.select("context", (F.col("lost") / F.col("total")).alias("weight"))})
        if order > 1:
            table = staged(table.groupBy(_shorter("code", order - 1).alias("code")).agg(F.count("*").alias("n")), "ngrams")
    return orders[::-1]


def probabilities(wanted: DataFrame, orders: list[dict[str, DataFrame]]) -> DataFrame:
    """``code, p`` of every different n-gram of ``wanted`` (column ``code``): the probability of its last symbol, by interpolation from the shortest order up."""
    asked = [staged(wanted.select("code").distinct(), "wanted")]
    for order in range(ORDER - 1, 0, -1):
        asked.insert(0, staged(asked[0].select(_shorter("code", order).alias("code")).distinct(), "wanted"))
    lower = None
    for order, (codes, parts) in enumerate(zip(asked, orders, strict=True), 1):
        found = codes.join(parts["own"], "code", "left").withColumn("context", _context("code")).join(parts["weights"], "context", "left")
        below = F.lit(1 / SYMBOLS)
        if lower is not None:
            found = found.withColumn("shorter", _shorter("code", order - 1)).join(lower.toDF("shorter", "below"), "shorter")
            below = F.col("below")
        p = F.coalesce("share", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * below  # an unseen context leaves all to the shorter order
        lower = staged(found.select("code", p.alias("p")), "probabilities")
    return lower


def log_table(orders: list[dict[str, DataFrame]]) -> np.ndarray:
    """The log probabilities of all symbols after each context of the longest order that was seen, one context after the other; to check a small model."""
    contexts = orders[-1]["weights"].select("context", F.explode(F.sequence(F.lit(0), F.lit(SYMBOLS - 1))).alias("symbol"))
    rows = probabilities(contexts.select((F.col("context") * SYMBOLS + F.col("symbol")).alias("code")), orders).orderBy("code")
    return np.log(rows.toArrow()["p"].to_numpy())


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Beginning and end of each run of equal keys."""
    if len(keys):
        starts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
        yield from zip(starts, starts[1:], strict=False)


def _of_groups(dealt: DataFrame, classes) -> DataFrame:
    """``group, code``: the different n-grams of each group of texts (``dealt``: group, text). A group's texts come one after the other."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, pa.array([], pa.int64())

        def rows() -> Iterator[pa.RecordBatch]:
            for begin in range(0, len(held), 100_000):
                part = held.slice(begin, 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), group, np.int64)), part], ["group", "code"])

        for batch in slices(batches):
            groups = batch.column(0).to_numpy()
            for begin, end in _runs(groups):
                if groups[begin] != group:
                    yield from rows()
                    group, held = int(groups[begin]), held.slice(0, 0)
                for some in _portions(batch.column(1).slice(begin, end - begin).to_pylist()):
                    new = pc.unique(pa.array(np.concatenate([codes_of(text, classes.value) for text in some])))
                    held = pc.unique(pa.concat_arrays([held, new]))
                    if len(held) > 4 * _AT_ONCE:  # whatever a group holds, a task does not
                        yield from rows()
                        held = held.slice(0, 0)
        yield from rows()

    ordered = dealt.repartition("group").sortWithinPartitions("group")
    return ordered.select("group", "text").mapInArrow(distinct, "group long, code long")


def perplexities(documents: DataFrame, classes, orders: list[dict[str, DataFrame]]) -> DataFrame:
    """``documents`` (columns ``text`` and others) with ``perplexity`` per character, null for empty texts, and without ``text``.

    Texts are dealt into groups by what is in their row. Only the different n-grams of a group meet the model, and the task that
    has the group's texts holds their probabilities.
    """
    rest = [c for c in documents.columns if c != "text"]
    size = documents.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    number = F.pmod(F.xxhash64("text", *rest), F.lit(size // GROUP_BYTES + 1))
    dealt = documents.select(number.alias("group"), "text", F.struct(*rest).alias("rest"))

    def known() -> DataFrame:
        wanted = staged(_of_groups(dealt, classes).distinct(), "asked")
        found = wanted.join(probabilities(wanted, orders), "code")
        return found.select("group", "code", F.log("p").cast("float").alias("log"))

    logs = settled(known, "logs")
    nothing = [F.lit(None).cast(dealt.schema[c].dataType).alias(c) for c in ("text", "rest")]
    texts = dealt.select("group", F.lit(None).cast("long").alias("code"), F.lit(None).cast("float").alias("log"), "text", "rest")
    both = logs.select("group", "code", "log", *nothing).union(texts)
    ordered = both.repartition("group").sortWithinPartitions("group", F.col("code").isNull())  # a group's n-grams, then its texts

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, codes, values = None, [], []
        for batch in slices(batches):
            key, code, log, text, own = batch.columns
            groups, is_text = key.to_numpy(), code.is_null().to_numpy(zero_copy_only=False)
            for begin, end in _runs(groups * 2 + is_text):
                if groups[begin] != group:
                    group, codes, values = groups[begin], [], []
                if not is_text[begin]:
                    codes.append(code.slice(begin, end - begin)), values.append(log.slice(begin, end - begin))
                    continue
                codes, values = ([pa.concat_arrays(x)] if x else [pa.array([], t)] for x, t in ((codes, pa.int64()), (values, pa.float32())))
                found = _perplexities(text.slice(begin, end - begin).to_pylist(), classes.value, codes[0], values[0].to_numpy())
                yield pa.RecordBatch.from_arrays([own.slice(begin, end - begin), pa.array(found, pa.float64())], ["rest", "perplexity"])

    scored = ordered.mapInArrow(score, StructType([dealt.schema["rest"]]).add("perplexity", DoubleType()))
    return scored.select(*(F.col("rest").getField(c).alias(c) for c in rest), "perplexity")


def _perplexities(texts: list[str | None], classes: np.ndarray, codes: pa.Array, logs: np.ndarray) -> list[float | None]:
    found: list[float] = []
    for some in _portions(texts):
        own = [codes_of(text, classes) for text in some]
        of = logs[pc.index_in(pa.array(np.concatenate(own)), value_set=codes).to_numpy()].astype(np.float64)
        starts = np.cumsum([0, *(len(x) for x in own[:-1])])
        found += np.exp(-np.add.reduceat(of, starts) / np.array([len(text) for text in some])).tolist()
    scores = iter(found)
    return [next(scores) if text else None for text in texts]


def classify(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    low: float = 0.001,
    high: float = 0.995,
    margin: float = 0.05,
) -> DataFrame:
    """``id, lang, perplexity, trusted, kept``, one row per input row.

    ``labels`` has ``id_col`` and ``quality``; texts with a quality of 1 (in all their label
    rows, if several) are trusted, and the model is of all of them. A text is kept if its
    perplexity lies between the ``low`` and ``high`` quantile of the trusted texts of its
    language, widened by ``margin``; a language without trusted text has those of all trusted
    texts, as has a null language. A null or empty text has no perplexity and is not kept. Without any trusted text nothing can be
    judged, and every text that is not empty is kept. Rows without an id are never trusted;
    repeated rows are judged, and counted, each for itself. Other columns are not read.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    good = labels.select(F.col(id_col).alias("id"), "quality").where("id IS NOT NULL").groupBy("id")
    good = good.agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).where("q = 1").select("id", F.lit(True).alias("trusted"))
    classes = spark.sparkContext.broadcast(alphabet(rows))
    # the same plan at any size: a few labels would be broadcast, many cannot be
    counts = ngram_counts(rows.join(good.hint("merge"), "id", "left_semi"), classes)
    orders = kneser_ney(counts)
    scored = perplexities(rows, classes, orders).join(good, "id", "left")
    scored = staged(scored.withColumn("trusted", F.coalesce("trusted", F.lit(False))), "scores")

    quantiles = F.percentile_approx("perplexity", [low, high], 10_000).alias("q")
    trusted = scored.where("trusted AND perplexity IS NOT NULL")
    by_lang = staged(trusted.where("lang IS NOT NULL").groupBy("lang").agg(quantiles), "limits")
    if by_lang.count() <= 10_000:  # as there are languages; beyond that it is no list of languages, and joined
        by_lang = F.broadcast(by_lang)
    overall = trusted.agg(quantiles).first()["q"]
    if overall is None:
        bounds = scored.withColumn("kept", F.col("perplexity").isNotNull())
        return bounds.select("id", "lang", "perplexity", "trusted", "kept")
    limits = F.coalesce("q", F.array(*map(F.lit, overall)))
    inside = F.col("perplexity").between(limits[0] * (1 - margin), limits[1] * (1 + margin))
    return scored.join(by_lang, "lang", "left").select(
        "id", "lang", "perplexity", "trusted", F.coalesce(inside, F.lit(False)).alias("kept")
    )
