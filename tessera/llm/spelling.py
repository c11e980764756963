"""Groups of spelling variants by asymmetric q-chunks.

Two words are near if they differ by one inserted, deleted or replaced code
point. The longer word (or, of two equally long, either) contributes two
disjoint chunks, its first and its second half; one edit leaves one of them
whole in the other word, where it stands at the same place or one to the left.
The other word contributes its positional grams: for each length its partner
may have, the substrings that such a chunk can meet within that shift. A
chunk's partners then differ by one edit in the rest of the word, and the rest
is cut again in the same way, so that words which share a common half (an
ending, a prefix) do not all meet: a key is a kept half and a kept half of the
rest. Spark joins keys, verifies every met pair by its edit distance and drops
pairs met twice. Hot keys are split by adaptive execution.

A word's form is its near word of largest count, if that is ``dominance``
times its own; counts grow along the forms, so chains are short and roots are
found by pointer jumping.

Words are counted in the tasks that read the texts; a task sends each distinct
word once per ``HELD`` words, so a common word is not shuffled by occurrence.

Defined cases: a NULL, empty or letterless text has no words; a NULL doc_id
counts as an empty id in the checksum; repeated rows count again, as more
occurrences; long texts are read in segments of ``SEGMENT`` bytes cut between
runs; equal counts go to the smaller word in code-point order; an empty table
gives no words. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.frames import documents, id_and_text, staged
from tessera.llm.textnum import SMALL_CHUNK, chunks

MIN_LENGTH, MIN_COUNT, DOMINANCE, NOISE = 7, 2, 10, 31
HELD = 100_000  # distinct words that a task holds before it sends them
SEGMENT = 1 << 20
_BETWEEN = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")  # bytes outside every run


def segments(text: bytes, size: int = SEGMENT) -> Iterator[str]:
    """The text, ASCII letters in lower case, in pieces that end between two runs of letters."""
    at = 0
    while len(text) - at > size:
        end = _BETWEEN.search(text, at + size)
        if end is None:
            break
        yield text[at:end.end()].lower().decode()
        at = end.end()
    yield text[at:].lower().decode()  # of bytes, lower() changes A-Z only


def words_of(doc_id: int | None, text: bytes, run: re.Pattern, shortest: int, noise: int | None) -> Counter:
    """Counts of the words of a text; runs whose checksum ``noise`` divides lose one code point."""
    out: Counter = Counter()
    seed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for part in segments(text):
        for w, n in Counter(run.findall(part)).items():
            if noise and (h := zlib.crc32(w.encode(), seed)) % noise == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
                if len(w) < shortest:
                    continue
            out[w] += n
    return out


def word_counts(docs: DataFrame, shortest: int = MIN_LENGTH, noise: int | None = None) -> DataFrame:
    """(word, n): runs of letters of at least ``shortest`` code points, with their occurrences in all texts."""
    def run(batches):
        pattern, held = re.compile("[a-zÀ-ÿ]{%d,}" % shortest), Counter()

        def sent():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             ["word", "n"])
            held.clear()
            return out

        for b, texts in chunks(batches, limit=SMALL_CHUNK):
            for d, t in zip(b.column("doc_id").to_pylist(), texts):
                held.update(words_of(d, t, pattern, shortest, noise))
                if len(held) > HELD:
                    yield sent()
        yield sent()

    sent = id_and_text(docs).select("doc_id", "text").mapInArrow(run, "word string, n long")
    return sent.groupBy("word").agg(F.sum("n").alias("n"))


def _keys(length) -> list:
    """The four keys of a word that plays the part of length ``length``: a half, and a half of the rest.

    The word itself may be one code point shorter; halves before the edit then
    stand at their places, halves behind it one to the left, that is, at the
    same distance from the end.
    """
    word, half = F.col("word"), F.floor(length / 2).cast("int")
    rest = (length - half).cast("int")
    near, far = F.floor(half / 2).cast("int"), F.floor(rest / 2).cast("int")

    def key(kind, head, tail):  # the first ``head`` and the last ``tail`` code points
        return F.concat_ws("\u0001", F.lit(kind), length.cast("string"), F.substring(word, F.lit(1), head), F.right(word, tail))

    none = F.lit(0)
    return [key("a", half + far, none), key("b", half, rest - far),  # first half kept
            key("c", near, rest), key("d", none, rest + half - near)]  # second half kept


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every unordered pair of near words once, from (word, n) with distinct words."""
    length = F.char_length("word")
    chunk = words.select("word", "n", F.explode(F.array(*_keys(length))).alias("key"))
    gram = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.explode(F.concat(
        F.array(*_keys(length)), F.array(*_keys(length + 1)))).alias("key"))
    longer = (F.char_length("word") > F.char_length("other")) | (F.col("word") < F.col("other"))
    met = chunk.join(gram, "key").where(longer & (F.levenshtein("word", "other", 1) == 1))
    return met.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("other").alias("b"),
                      F.col("other_n").alias("b_n")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form, from (word, form): the end of its chain, by pointer jumping."""
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        at = staged(at.join(ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
        if not at.where("moved").limit(1).count():
            return at.drop("moved")


def variant_forms(docs: DataFrame, shortest: int = MIN_LENGTH, least: int = MIN_COUNT, dominance: int = DOMINANCE,
                  noise: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of at least ``shortest`` code points and ``least`` occurrences.

    ``noise`` deletes a code point of one run in so many, chosen by checksum (a test of recovery from misspelling).
    """
    words = staged(word_counts(docs, shortest, noise).where(F.col("n") >= least), "words")
    pairs = staged(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("near")).alias("x")) \
        .unionByName(pairs.select(F.col("b").alias("word"),
                                  F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("near")).alias("x")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("x").alias("x"))
    ruled = -F.col("x.n") >= dominance * F.col("n")
    known = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(ruled, F.col("x.near")).alias("form"), F.when(ruled, -F.col("x.n")).alias("form_n")), "forms")
    return known.join(roots(known.where("form IS NOT NULL")), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words' counts, forms and roots."""
    return variant_forms(documents(spark, sf_dir), noise=NOISE)
