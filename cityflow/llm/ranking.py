"""Ranked lexical search, term at a time with limited accumulators.

Documents are cut into shards; a shard keeps the postings of the terms that
queries ask for. A query walks its terms from the rarest on and adds each
posting's score to the accumulator of its document. Once the bounds of the
terms to come cannot lift an unseen document to the k-th best partial score,
no accumulator is made any more, and those that can still reach it are updated
exactly. The best of all shards are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.llm.common import materialise
from cityflow.llm.shingles import _word_hashes, grouped_texts

# The characters of a term, and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WEIGHT_SCALE, TF_SCALE, TF_STEP, LENGTH_STEP = 1000, 1_000_000_000, 1000, 8
LENGTH_BASE, LENGTH_SHARE = 10, 90
#: Bits of the filter that keeps terms no query asks for out of the shards: 1 MB whatever the queries are.
FILTER_BITS = 23
#: Documents and code points of a shard (a longer document is one alone), and bytes of the terms of a query group.
SHARD_DOCS, SHARD_CHARS, GROUP_BYTES = 1 << 14, 1 << 25, 1 << 22

#: Rows of a shard: one with a null term (ids and lengths of its documents; n: those with a term, total: all their
#: terms), and one for each term (positions of its documents in that list, frequencies; n: how many).
POSTINGS = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("term", T.StringType()), T.StructField("docs", T.ArrayType(T.LongType())),
    T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("n", T.LongType()), T.StructField("total", T.LongType())])

# Bytes outside terms become spaces, A-Z small letters; bytes from 0x80 on belong to characters of terms.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def folded(text: str | None) -> bytes:
    """UTF-8 of a text with its terms apart by spaces."""
    return (text or "").encode("utf-8").translate(_FOLD)


def _filter_places(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, place in the filter) of the terms of folded text."""
    hashes, starts = _word_hashes(np.frombuffer(raw, np.uint8))
    return hashes, starts, (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(item, term)``; rows of one id are one item, null ids too."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(item, term.decode()) for item, text in zip(batch.column(0).to_pylist(), batch.column(1)) for term in set(folded(text.as_py()).split())]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], names=["item", "term"])
    return items.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, "item long, term string").distinct()


def term_filter(terms: DataFrame) -> np.ndarray:
    """Which places of the filter some term of ``terms`` has.

    Made on the executors in words of 64 places, so at most 2^17 rows reach
    the driver.
    """
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            if batch.num_rows:
                held[_filter_places(" ".join(batch.column(0).to_pylist()).encode())[2]] = True
        words = np.packbits(held).view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["word", "bits"])
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for word, bits in terms.select("term").mapInArrow(places, "word long, bits long").groupBy("word").agg(F.bit_or("bits")).collect():
        out[word] = bits
    return np.unpackbits(out.view(np.uint8)).astype(bool)


class Shard:
    """Documents of a shard in the making."""

    def __init__(self, wanted: np.ndarray):
        self._wanted, self.chars = wanted, 0
        self.ids, self._sizes, self._docs, self._hashes, self._names = [], [], [], [], {}

    def add(self, ids: list[int | None], texts: list[str | None]) -> None:
        parts = [folded(t) for t in texts]
        first = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        raw = b" ".join(parts)
        hashes, starts, places = _filter_places(raw)
        doc = np.searchsorted(first, starts, side="right") - 1
        self._sizes.append(np.bincount(doc, minlength=len(texts)))
        asked = self._wanted[places]
        doc, hashes, starts = doc[asked], hashes[asked], starts[asked]
        for h, at in zip(*(x.tolist() for x in _first_of_each(hashes, starts))):
            if h not in self._names:
                end = raw.find(b" ", at)
                self._names[h] = raw[at:end if end >= 0 else len(raw)].decode("utf-8")
        self._docs.append(doc + len(self.ids))
        self._hashes.append(hashes)
        self.ids.extend(ids)
        self.chars += len(raw)

    def rows(self, shard: int) -> pa.RecordBatch:
        """The shard as ``POSTINGS``."""
        sizes, doc, hashes = (np.concatenate(x) for x in (self._sizes, self._docs, self._hashes))
        order = np.lexsort((doc, hashes))
        doc, hashes = doc[order], hashes[order]
        first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1]))) if len(doc) else np.empty(0, np.int64)
        times = np.diff(np.append(first, len(doc)))
        doc, hashes = doc[first], hashes[first]
        term = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(doc) else np.empty(0, np.int64)
        n = np.diff(np.append(term, len(doc)))
        offsets = pa.array(np.concatenate([[0, len(sizes)], len(sizes) + np.cumsum(n)]), pa.int32())
        ids = pa.concat_arrays([pa.array(self.ids, pa.int64()), pa.array(doc, pa.int64())])
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(n) + 1, shard)), pa.array([None, *(self._names[h] for h in hashes[term].tolist())], pa.string()),
            pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([sizes, times]), pa.int64())),
            pa.array(np.concatenate([[np.count_nonzero(sizes)], n]), pa.int64()),
            pa.array(np.concatenate([[sizes.sum()], np.add.reduceat(times, term) if len(term) else []]), pa.int64())], names=POSTINGS.names)


def _first_of_each(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_index=True)
    return found, values[at]


def postings(documents: DataFrame, wanted: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``POSTINGS`` of all documents, for the terms whose place in the filter is wanted; write it before using ``shard`` as a key.

    A term that only shares its place with a wanted one has rows too; they
    meet no query.
    """
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, held = TaskContext.get().partitionId() << 32, Shard(wanted)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in grouped_texts(batch.column(1)):
                held.add(ids[first:first + len(texts)], texts)
                if len(held.ids) >= SHARD_DOCS or held.chars >= SHARD_CHARS:
                    yield held.rows(number)
                    number, held = number + 1, Shard(wanted)
        if held.ids:
            yield held.rows(number)
    return documents.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(index, POSTINGS)


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Searcher:
    """Term-at-a-time search of one shard.

    ``found`` maps a term to the ascending positions of its documents and
    their frequencies; ``lengths`` are the documents' sizes in terms.
    """

    def __init__(self, lengths: np.ndarray, found: dict[str, tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int):
        self._scale = LENGTH_BASE + (LENGTH_SHARE * lengths * n_docs) // max(n_terms, 1)
        self._found, self._n_docs, self._impacts = found, n_docs, {}
        #: Accumulators made and postings read, for tests and tuning.
        self.made, self.read = 0, 0

    def _impact(self, term: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions of a term, what a unit of weight adds there, and the most of it."""
        if term not in self._impacts:
            at, tf = self._found[term]
            add = (TF_SCALE * tf) // (TF_STEP * tf + LENGTH_STEP * self._scale[at])
            self._impacts[term] = at, add, int(add.max())
        return self._impacts[term]

    def scores(self, terms: list[tuple[int, str]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of documents among which the k best are; ``terms`` are (document frequency, term)."""
        walk = [(weight(self._n_docs, df), *self._impact(term)) for df, term in sorted(terms) if term in self._found]
        bound = np.cumsum([0] + [w * most for w, _, _, most in reversed(walk)])[::-1].tolist()
        score, alive = np.zeros(len(self._scale), np.int64), None
        for (w, at, add, _), rest in zip(walk, bound):
            if alive is None and score.max() > rest:
                best = score[score > 0]
                if len(best) >= k and (kth := np.partition(best, len(best) - k)[len(best) - k]) > rest:
                    alive = np.flatnonzero(score + rest >= kth)
                    self.made += len(best)
            if alive is None:
                score[at] += w * add
                self.read += len(at)
            else:
                place = np.minimum(np.searchsorted(at, alive), len(at) - 1)
                hit = at[place] == alive
                score[alive[hit]] += w * add[place[hit]]
                self.read += len(alive)
        if alive is None:
            alive = np.flatnonzero(score > 0)
            self.made += len(alive)
        return alive, score[alive]


def _best(ids: np.ndarray, known: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0, equal ones by id (unknown ids first)."""
    order = np.lexsort((ids, known, -score))[:k]
    return order[score[order] > 0]


def query_groups(terms: DataFrame, frequencies: DataFrame) -> tuple[DataFrame, int]:
    """The items with their terms and these' document frequencies, in groups of about ``GROUP_BYTES``: ``(group, queries)`` and how many."""
    size = terms.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    items = (terms.join(frequencies, "term").groupBy("item").agg(F.collect_list(F.struct("df", "term")).alias("terms")))
    return (items.groupBy(F.pmod(F.xxhash64("item"), F.lit(groups)).alias("group"))
            .agg(F.collect_list(F.struct("item", "terms")).alias("queries"))), groups


def search(documents: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item, rank, id, score)``: the ``k`` documents with the highest scores above 0 for each item.

    Terms, weights and scores are those of the module's fixed values, over
    all documents; equal scores are ranked by ascending id. Null and empty
    texts have no terms: such documents do not count, such items have no
    rows. Rows of ``items`` with equal ids are one item; document rows that
    repeat are ranked each. Null ids are allowed on both sides; empty tables
    give an empty result.

    Documents never move: the postings of a shard are made in one task, and
    at most ``k`` rows an item leave each shard. Every group of queries is a
    row of about ``GROUP_BYTES`` that meets all shards; the driver holds the
    filter and three sums.
    """
    terms = materialise(query_terms(items, item_col, item_text_col), "query-terms")
    posted = materialise(postings(documents, term_filter(terms), id_col, text_col), "postings")
    heads = posted.where("term is null")
    n_docs, n_terms = heads.agg(F.sum("n"), F.sum("total")).first()
    frequencies = posted.where("term is not null").groupBy("term").agg(F.sum("n").alias("df"))
    grouped, n_groups = query_groups(terms, frequencies)
    grouped = materialise(grouped, "query-groups")

    def ranked(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        head, ids, lengths, queries, found = None, None, None, [], {}
        for term, docs, counts, asked in zip(rows["term"], rows["docs"], rows["counts"], rows["queries"]):
            if asked.is_valid:
                queries = asked.as_py()
            elif term.is_valid:
                found[term.as_py()] = docs.values.to_numpy(), counts.values.to_numpy()
            else:
                head, lengths = docs.values, counts.values.to_numpy()
        out = [[], [], []]
        if queries and len(head):
            known, ids = head.is_valid().to_numpy(zero_copy_only=False), head.fill_null(0).to_numpy()
            searcher = Searcher(lengths, found, n_docs, n_terms)
            for query in queries:
                at, score = searcher.scores([(t["df"], t["term"]) for t in query["terms"]], k)
                best = _best(ids[at], known[at], score, k)
                for column, values in zip(out, ([query["item"]] * len(best), [i if v else None for i, v in zip(ids[at[best]].tolist(), known[at[best]])],
                                                score[best].tolist())):
                    column.extend(values)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("item", "id", "score"), out)})

    asked = "array<struct<item: bigint, terms: array<struct<df: bigint, term: string>>>>"
    slim = posted.select("shard", "term", "docs", "counts", F.lit(None).cast(asked).alias("queries"))
    found = None
    for group in range(n_groups):
        # One row of bounded size goes to every shard.
        one = F.broadcast(grouped.where(F.col("group") == group))
        with_queries = (heads.select("shard", F.lit(group).cast("long").alias("group")).join(one, "group")
                        .select("shard", F.lit(None).cast("string"), F.lit(None).cast("array<bigint>"), F.lit(None).cast("array<bigint>"), F.col("queries").cast(asked)))
        part = slim.union(with_queries).groupBy("shard").applyInArrow(ranked, "item long, id long, score long")
        found = part if found is None else found.union(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item", "rank", "id", "score")


def op13_search(documents: DataFrame, items: DataFrame) -> DataFrame:
    return search(documents, items).withColumnsRenamed({"item": "item_id", "id": "doc_id"})


OP13_SQL = f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM documents),
     q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark),
     size AS (SELECT doc_id, count(*)::BIGINT AS n FROM t GROUP BY doc_id),
     whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
     p AS (SELECT term, doc_id, count(*)::BIGINT AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
     w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, whole GROUP BY term),
     m AS (SELECT doc_id, 10 + (90 * n * n_docs) // n_terms AS m FROM size, whole),
     s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
