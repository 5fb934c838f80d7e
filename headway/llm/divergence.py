"""Source divergence audit: how the terms of each source differ from those of other sources and of its language.

For each language a ``CountVectorizer`` (at least three documents a term, the largest vocabulary an integer allows) turns
documents into exact sparse count vectors, whose entries are added up by source: a row for each term, with the sources that have it.
Everything behind works on those rows. Shares are integers: ``p = 1 + floor(10^9 (count + 1) / (N + V))``.

*Folded documents.* A vectorizer's work grows with the words it is given, so tasks fold the documents of some megabytes first, and
nothing that it finds changes. It is fitted on documents in which a term is once for each document of its language that holds it, as far
as ``least`` of them: that many hold it in all just when that many did before. It transforms documents of one source that have a weight,
a power of two, and hold the terms whose number there has that binary digit: their vectors, times the weights, add up to the same counts.

*Pairs of sources* are evaluated on what is not zero. Were both counts of every term zero, the value would be V times one number;
what the terms of the one source, and of the other, change in that depends on a term's count alone, so it is added up over the
histogram of counts of that source; only for terms that both have, what they change together is added up, by integers in numpy.

*Bounded driver.* A fit holds its vocabulary on the driver and sends it to tasks. Languages with more than ``SLICE_TERMS`` terms are
fitted in slices of their terms by hash, each a vectorizer of its own; the vectors of all slices together are the exact ones.
Folded documents are staged once, a folder for each language, so every fit reads its own language only.

Defined results: null text, lang and source are empty strings; every row is a document, repeated or not; a language without kept terms
has pairs of value 0 and no terms; a language with one source has no pairs; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from headway.llm.common import batch_of, mapped
from headway.session import run_folder, staged

#: Documents that hold a kept term, at least; the units shares are counted in; ranks of terms that are reported.
LEAST_DOCUMENTS, UNITS, TOP = 3, 1_000_000_000, 200
#: The largest vocabulary a vectorizer can be asked for.
WHOLE_VOCABULARY = 2**31 - 1
#: Terms of a language, about, that one fit may bring to the driver.
SLICE_TERMS = 1_000_000
#: Share of terms, by hash, that are counted to tell how many slices to take.
SAMPLED = 1 / 16
#: Bytes of text a task folds at once (one document at least), and terms that a folded document has at most; bounds memory, never results.
FOLD_BYTES, FOLD_TERMS = 16_000_000, 20_000
#: Pairs of sources that are evaluated at once.
PAIRS = 1 << 19
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Byte by byte: A to Z in lower case, other ASCII than letters a blank, what is beyond ASCII as it is. Terms are what blanks part.
BLANK = 32
TERMS = bytes(b if b >= 128 or chr(b) in LOWER else b + 32 if chr(b) in UPPER else BLANK for b in range(256))
FOLD_SCHEMA = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("weight", pa.int64()), ("documents", pa.int64()), ("terms", pa.list_(pa.string()))]
)


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The same rows, ``most`` bytes of text at a time (one row at least)."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            end = max(int(np.searchsorted(ends, before + most - size, side="right")), begin if held else begin + 1)
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                size += int(ends[end - 1]) - before
            begin = end
            if begin < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of all texts in order, by number of a dictionary, and the text each is in.

    Terms are longest runs of ASCII letters and anything beyond ASCII, only A to Z in lower case.
    """
    texts = texts.cast(pa.large_binary())
    edges = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer((raw.slice(int(edges[0]), int(edges[-1] - edges[0])).to_pybytes() if raw else b"").translate(TERMS), dtype=np.uint8)
    edges = edges - edges[0]
    inside = data != BLANK
    # A term ends where its text does.
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[edges] = True
    cut[1:] |= ~inside
    starts = np.flatnonzero(inside & cut[:-1])
    cut[:-1] |= ~inside
    cut[edges] = True
    ends = np.flatnonzero(inside & cut[1:]) + 1
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    held = np.diff(np.searchsorted(starts, edges))
    del cut, starts, ends
    data = data[inside]
    del inside
    terms = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return terms.dictionary_encode(), np.repeat(np.arange(len(texts)), held)


def _counted(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number once, in order, and how often it is there. Sorts in place."""
    numbers.sort()
    heads = np.flatnonzero(np.diff(numbers, prepend=-1))
    return numbers[heads], np.diff(np.append(heads, len(numbers)))


def _folder(least: int, most: int):
    """Tasks that fold documents: weight 0 for those to fit on, others for those to transform."""

    def fold(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        langs, sources = (rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
        lang, source = (x.indices.to_numpy().astype(np.int64) for x in (langs, sources))
        group, of = np.unique(lang * len(sources.dictionary) + source, return_inverse=True)
        terms, text = _terms(rows.column("text").combine_chunks())
        code, known = terms.indices.to_numpy(), max(1, len(terms.dictionary))
        numbers = of[text] * known
        numbers += code
        found, counts = _counted(numbers)
        text *= known
        text += code
        held, _ = _counted(text)
        del numbers, text, code
        held, documents = _counted(lang[held // known] * known + held % known)
        for i, (name, n) in enumerate(zip(langs.dictionary, np.bincount(lang).tolist())):
            a, b = np.searchsorted(held, (i * known, (i + 1) * known))
            for level in range(least):
                some = held[a:b][documents[a:b] > level] % known
                yield from folded(name, None, 0, 0 if level else n, terms.dictionary, some)
        for i, g in enumerate(group.tolist()):
            a, b = np.searchsorted(found, (i * known, (i + 1) * known))
            name, other = langs.dictionary[g // len(sources.dictionary)], sources.dictionary[g % len(sources.dictionary)]
            for digit in range(int(counts[a:b].max(initial=1)).bit_length()):
                yield from folded(name, other, 1 << digit, 0, terms.dictionary, found[a:b][counts[a:b] >> digit & 1 > 0] % known)

    def folded(lang, source, weight: int, documents: int, dictionary: pa.Array, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = dictionary.take(pa.array(places))
        for begin in range(0, max(1, len(names)), FOLD_TERMS):
            part = names.slice(begin, FOLD_TERMS)
            lists = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
            yield batch_of(
                FOLD_SCHEMA, lang=pa.array([lang.as_py()]), source=pa.array([source.as_py() if source else None], pa.string()),
                weight=[weight], documents=[0 if begin else documents], terms=lists,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches, most):
            yield from fold(rows)

    return run


def _slices(rows: DataFrame, least: int, slice_terms: int) -> dict[str, tuple[int, int]]:
    """For each language key its documents, and the slices its terms are fitted in: told from the kept ones of a share of terms."""
    fits = rows.where(F.col("weight") == 0)
    chance = F.pmod(F.xxhash64("term", F.lit("sample")), F.lit(1 << 20)) < int(SAMPLED * (1 << 20))
    kept = fits.select("lang_key", F.explode("terms").alias("term")).where(chance).groupBy("lang_key", "term").count().where(F.col("count") >= least)
    terms = kept.groupBy("lang_key").agg(F.count(F.lit(1)).alias("terms"))
    known = fits.groupBy("lang_key").agg(F.sum("documents").alias("documents")).join(terms, "lang_key", "left")
    return {r["lang_key"]: (r["documents"], 1 + int((r["terms"] or 0) / SAMPLED) // slice_terms) for r in known.collect()}


def source_counts(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, slice_terms: int = SLICE_TERMS, fold_bytes: int = FOLD_BYTES
) -> tuple[DataFrame, DataFrame]:
    """``lang_key, lang, source`` of all groups; ``lang_key, term, cells`` of kept terms with their sources and counts."""
    spark = docs.sparkSession
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    path = f"{run_folder(spark)}/terms"
    folded = mapped(texts, _folder(least, fold_bytes), "lang string, source string, weight long, documents long, terms array<string>")
    folded.withColumn("lang_key", F.md5("lang")).write.partitionBy("lang_key").parquet(path)
    rows = spark.read.schema("lang string, source string, weight long, documents long, terms array<string>, lang_key string").parquet(path)
    counted = []
    for key, (documents, slices) in sorted(_slices(rows, least, slice_terms).items()):
        for n in range(slices if documents >= least else 0):
            own = rows.where(F.col("lang_key") == key)
            if slices > 1:
                own = own.withColumn("terms", F.filter("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(slices)) == n))
            part = _slice_counts(own.select("source", "weight", "terms"), least)
            if part is not None:
                counted.append(part.select(F.lit(key).alias("lang_key"), "term", "cells"))
    groups = staged(rows.where(F.col("weight") > 0).select("lang_key", "lang", "source").distinct())
    if not counted:
        return groups, spark.createDataFrame([], "lang_key string, term string, cells array<struct<source:string,count:bigint>>")
    whole = counted[0]
    for more in counted[1:]:
        whole = whole.unionByName(more)
    return groups, whole


def _slice_counts(rows: DataFrame, least: int) -> DataFrame | None:
    """``term, cells``: over the document vectors of one fit, added up by source without making them dense.

    A term's cells are its sources: no more than the language has.
    """
    spark = rows.sparkSession
    vectorizer = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(least), vocabSize=WHOLE_VOCABULARY)
    model = vectorizer.fit(rows.where(F.col("weight") == 0))
    vocabulary = model.vocabulary
    if not vocabulary:
        return None
    vector = F.unwrap_udt("vector")
    entries = model.transform(rows.where(F.col("weight") > 0)).select(
        "source", "weight", F.inline(F.arrays_zip(vector["indices"].alias("place"), vector["values"].alias("n")))
    )
    # Dealt by place once, which serves both steps: few entries of a task are of one source and term.
    sums = entries.repartition("place").groupBy("place", "source").agg(F.sum(F.col("n").cast("long") * F.col("weight")).alias("count"))
    cells = sums.groupBy("place").agg(F.collect_list(F.struct("source", "count")).alias("cells"))
    names = spark.createDataFrame(
        pa.table({"place": pa.array(range(len(vocabulary)), pa.int32()), "term": pa.array(vocabulary, pa.string())})
    )
    return staged(cells.join(names, "place").select("term", "cells"))


def share(count: Column, size: Column, terms: Column) -> Column:
    """A term's share in units, rounded down, one more at least; counts of any size fit."""
    whole = F.lit(UNITS).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", whole, (size + terms).cast("decimal(19,0)"))


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``: no overflow, as shares are little over 10^9."""
    return F.call_function("div", (p - q) * (p - q), q)


PAIR_SCHEMA = pa.schema([("lang_key", pa.string()), ("source", pa.string()), ("other", pa.string()), ("value", pa.int64())])


class Sizes(NamedTuple):
    """Of one language: its sources in order, their sizes, and its kept terms."""

    sources: list[str]
    sizes: np.ndarray
    terms: int

    def share(self, count: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact while counts stay under 9 * 10^9; beyond, in Python's integers."""
        if len(count) and count.max() >= 9 * 10**9:
            return np.array([1 + UNITS * (c + 1) // (n + self.terms) for c, n in zip(count.tolist(), self.sizes[at].tolist())], dtype=np.int64)
        return 1 + UNITS * (count + 1) // (self.sizes[at] + self.terms)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _both(of: Sizes, term: np.ndarray, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """What terms that two sources both have add to their value: sources by number, and the sum. Rows are sorted by term."""
    k = len(of.sources)
    p, p0 = of.share(count, at), of.share(np.zeros(k, dtype=np.int64), np.arange(k))
    # For each row the first one of its term, and how many the term has: with so many it makes pairs.
    edges = np.flatnonzero(np.diff(term, prepend=-1))
    size = np.diff(np.append(edges, len(term)))
    first, each = np.repeat(edges, size), np.repeat(size, size)
    before = np.concatenate(([0], np.cumsum(each)))
    sums: dict[int, int] = defaultdict(int)
    begin = 0
    while begin < len(term):
        end = max(begin + 1, int(np.searchsorted(before, before[begin] + PAIRS, side="right")) - 1)
        left = np.repeat(np.arange(begin, end), each[begin:end])
        right = np.arange(len(left)) - np.repeat(before[begin:end] - before[begin] - first[begin:end], each[begin:end])
        a, b = at[left], at[right]
        x, y, x0, y0 = p[left], p[right], p0[a], p0[b]
        value = _gap(x, y) - _gap(x, y0) - _gap(x0, y) + _gap(x0, y0)
        code = a * k + b
        order = np.argsort(code, kind="stable")
        starts = np.flatnonzero(np.diff(code[order], prepend=-1))
        for c, v in zip(code[order][starts].tolist(), np.add.reduceat(value[order], starts).tolist()):
            sums[c] += v
        begin = end
    codes = np.array(sorted(c for c in sums if c // k != c % k), dtype=np.int64)
    return codes // max(1, k), codes % max(1, k), np.array([sums[c] for c in codes.tolist()], dtype=np.int64)


def _pair_adder(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {key: {s: i for i, s in enumerate(of.sources)} for key, of in sent.value.items()}
        for batch in batches:
            keys = batch.column("lang_key").to_numpy(zero_copy_only=False)
            lists = batch.column("cells")
            flat = lists.flatten()
            term = np.repeat(np.arange(len(keys)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            source = flat.field("source").dictionary_encode()
            named, count = source.indices.to_numpy(), flat.field("count").to_numpy()
            for key in sorted(set(keys.tolist())):
                own = keys[term] == key
                at = np.array([numbers[key].get(s, 0) for s in source.dictionary.to_pylist()], dtype=np.int64)[named[own]]
                a, b, value = _both(sent.value[key], term[own], at, count[own])
                names = sent.value[key].sources
                yield batch_of(
                    PAIR_SCHEMA, lang_key=[key] * len(a), source=[names[i] for i in a.tolist()], other=[names[i] for i in b.tolist()], value=value
                )

    return run


def pair_values(groups: DataFrame, terms: DataFrame, levels: DataFrame) -> DataFrame:
    """``lang_key, lang, source, other, value`` for each source and each other one of its language.

    ``groups``: ``lang_key, lang, source, size, terms`` (kept by the language) and ``zero``, the share of a term the source has not;
    ``terms``: ``lang_key, cells`` of kept terms; ``levels``: how many terms have a share in a source.
    """
    mine = groups.select("lang_key", "lang", "source", "terms", F.col("zero").alias("p0"))
    its = groups.select("lang_key", F.col("source").alias("other"), F.col("zero").alias("q0"))
    pairs = staged(mine.join(its, "lang_key").where(F.col("source") != F.col("other")))
    at = ["lang_key", "source", "other"]
    f00 = gap(F.col("p0"), F.col("q0"))
    base = pairs.select(*at, (F.col("terms") * f00).alias("value"))
    # Terms with equal counts change a pair alike.
    own = pairs.join(levels, ["lang_key", "source"]).select(*at, (F.col("m") * (gap(F.col("share"), F.col("q0")) - f00)).alias("value"))
    theirs = pairs.join(levels.withColumnRenamed("source", "other"), ["lang_key", "other"]).select(
        *at, (F.col("m") * (gap(F.col("p0"), F.col("share")) - f00)).alias("value")
    )
    # A row for each group; the result itself holds one for each pair of them.
    known: dict[str, list] = defaultdict(list)
    for r in groups.select("lang_key", "source", "size", "terms").toLocalIterator():
        known[r["lang_key"]].append((r["source"], r["size"], r["terms"]))
    sizes = {k: Sizes([x[0] for x in sorted(v)], np.array([x[1] for x in sorted(v)], dtype=np.int64), v[0][2]) for k, v in known.items()}
    sent = groups.sparkSession.sparkContext.broadcast(sizes)
    both = mapped(terms.select("lang_key", "cells"), _pair_adder(sent), "lang_key string, source string, other string, value long")
    # Each part is added up by itself first: no more rows meet than pairs.
    parts = [x.groupBy(*at).agg(F.sum("value").alias("value")) for x in (base, own, theirs, both)]
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    values = whole.groupBy(*at).agg(F.sum("value").alias("value"))
    return values.join(groups.select("lang_key", "lang", "source"), ["lang_key", "source"])


def term_values(groups: DataFrame, cells: DataFrame, top: int) -> DataFrame:
    """``lang, source, term, value, rank`` of the terms a source has more of than its language, only the first ranks."""
    more = cells.where(F.col("share") > F.col("q"))
    ranked = W.partitionBy("lang_key", "source").orderBy(F.desc("value"), "term")
    first = more.select("lang_key", "source", "term", gap(F.col("share"), F.col("q")).alias("value")).withColumn(
        "rank", F.row_number().over(ranked)
    ).where(F.col("rank") <= top)
    return first.join(groups.select("lang_key", "lang", "source"), ["lang_key", "source"])


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` (all ranks) and ``term`` (ranks to ``top``)."""
    groups, terms = source_counts(docs, least, slice_terms)
    vocabulary = terms.groupBy("lang_key").agg(F.count(F.lit(1)).alias("terms"))
    total = F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + c["count"])
    flat = terms.select("lang_key", "term", total.alias("total"), F.inline("cells"))
    sizes = staged(flat.groupBy("lang_key", "source").agg(F.sum("count").alias("size")))
    whole = sizes.groupBy("lang_key").agg(F.sum("size").alias("whole"))
    known = groups.join(vocabulary, "lang_key", "left").join(whole, "lang_key", "left").join(sizes, ["lang_key", "source"], "left")
    none = F.lit(0).cast("long")
    # Without terms there is nothing to share; one keeps the division defined.
    zero = F.when(F.col("terms") > 0, share(none, F.col("size"), F.col("terms"))).otherwise(F.lit(1).cast("long"))
    groups = staged(known.na.fill(0, ["terms", "size", "whole"]).withColumn("zero", zero))
    cells = flat.join(groups.select("lang_key", "source", "terms", "size", "whole"), ["lang_key", "source"]).select(
        "lang_key", "source", "term", share(F.col("count"), F.col("size"), F.col("terms")).alias("share"),
        share(F.col("total"), F.col("whole"), F.col("terms")).alias("q"),
    )
    levels = staged(cells.groupBy("lang_key", "source", "share").agg(F.count(F.lit(1)).alias("m")))
    pairs = pair_values(groups, terms, levels)
    order = W.partitionBy("lang_key", "source").orderBy(F.desc("value"), "other")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    first = term_values(groups, cells, top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank").unionByName(
        first.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    ).select(*columns)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: each source against the other sources of its language, and its terms against the language's."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same in SQL, every term of every pair evaluated.
SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), vocabulary AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), sizes AS (
  SELECT lang, source, coalesce(sum(n), 0) AS size FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (size + v) AS HUGEINT) AS p
  FROM sizes JOIN kept USING (lang) JOIN vocabulary USING (lang) LEFT JOIN counts USING (lang, source, term)
), totals AS (
  SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + v) AS HUGEINT) AS q
  FROM shares JOIN vocabulary USING (lang) GROUP BY lang, term, v
), pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value
  FROM shares JOIN totals USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, CAST(place AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR place <= 200
"""
