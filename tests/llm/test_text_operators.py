"""Alignment, fingerprints and ranked search against plain Python, and their edge cases."""

import hashlib
import json
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cityflow.llm import alignment, fingerprints, ranking
from tests.conftest import SF001
from tests.llm.test_llm import CLASHES, LONG, ODD, SCHEMA

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EXTRA = [(20, "a ▁ b", None, None, 0), (21, "<|endoftext|> <s> <0x41> \x00 ﬁ x  \n\n y é日本😀", None, None, 0), (22, " lead\ttab  two ", None, None, 0),
         (23, "x" * 70_000 + " y z", None, None, 0), (24, "Ünïcode TERMS terms Terms É é", None, None, 0), (None, "", None, None, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ODD + EXTRA, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def clashing(docs):
    names = [*CLASHES, "row", "same", "odd", "range", "mark", "at", "tail", "first", "before", "shard", "term", "docs", "counts", "n", "total"]
    return docs.select("*", *[F.lit("x").alias(c) for c in dict.fromkeys(names)])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------ alignment
def brute_alignment(pairs):
    import sentencepiece
    from tokenizers import Tokenizer
    a_enc = Tokenizer.from_file(A_PATH)
    a_enc.encode_special_tokens = True
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    a_bytes = {i: bytes(letters[c] for c in w) for w, i in json.load(open(A_PATH))["model"]["vocab"].items() if w != "<|endoftext|>"}
    b_enc = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    b_piece = lambda i: bytes([int(b_enc.id_to_piece(i)[3:5], 16)]) if b_enc.is_byte(i) else b_enc.id_to_piece(i).replace("▁", " ").encode()

    def spans(ids, size):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(size(i)), i))
            at = out[-1][1]
        return out
    heads, links = [], []
    for doc, text in pairs:
        a = a_enc.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_enc.encode(text, num_threads=1) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(map(a_bytes.get, a)) != whole or b"".join(map(b_piece, b)) != whole:
            heads.append((doc, 0, 0, 0, ""))
            links.append([])
            continue
        sa, sb = spans(a, a_bytes.get), spans(b, b_piece)
        cuts = [0, *sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})]
        groups, linked, i, j = [], [], 0, 0
        for stop in cuts[1:]:
            ga, gb = [], []
            while i < len(sa) and sa[i][1] <= stop:
                ga.append(sa[i])
                i += 1
            while j < len(sb) and sb[j][1] <= stop:
                gb.append(sb[j])
                j += 1
            groups.append(",".join(str(x[2]) for x in ga) + "|" + ",".join(str(x[2]) for x in gb))
            linked += [(x[2], y[2]) for x in ga for y in gb if x[0] < y[1] and y[0] < x[1]]
        heads.append((doc, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(linked)
    count, best = Counter(p for x in links for p in set(x)), defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(d, a, b, g, len(x), sum(count[p] == best[p[0]] for p in x), sum(count[p] for p in x), s) for (d, a, b, g, s), x in zip(heads, links)]


def test_alignment_equals_brute_force(spark, docs, clashing):
    real = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    both = docs.select("doc_id", "text").union(real)
    want = sorted(brute_alignment([tuple(r) for r in both.collect()]), key=repr)
    got = alignment.op11_alignment(both.repartition(4), A_PATH, B_PATH)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(got) == want
    assert rows(alignment.op11_alignment(clashing, A_PATH, B_PATH)) == rows(alignment.op11_alignment(docs, A_PATH, B_PATH))


def test_alignment_of_unreadable_texts_and_of_no_rows(spark, docs):
    found = {r.doc_id: r for r in alignment.op11_alignment(docs, A_PATH, B_PATH).collect()}
    for doc in (1, 2, 20):
        assert tuple(found[doc])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert found[21].n_groups > 0 and found[7].groups_sha256 == found[6].groups_sha256
    assert alignment.op11_alignment(spark.createDataFrame([], SCHEMA), A_PATH, B_PATH).collect() == []


def test_identity_map_and_cuts():
    pair = alignment.Pair(A_PATH, B_PATH)
    hit = np.flatnonzero(pair.same >= 0)
    assert len(hit) > 10_000 and all(pair.a_bytes[i] == pair.b_bytes[pair.same[i]] for i in hit)
    assert not pair._b.is_byte(int(pair.same[pair.a_bytes.index(b"a")]))
    text = " ".join(f"Wörter, {i} und\n\tmehr  davon" for i in range(6000))
    cut = pair.encode(text)
    pair._cuttable = False
    whole = pair.encode(text)
    assert all((x == y).all() for x, y in zip(cut, whole)) and len(text) > 2 * alignment.PIECE_CHARS


def test_only_irregular_links_are_shuffled(spark):
    docs = spark.createDataFrame([(i, "the house and the garden of the city") for i in range(50)], "doc_id long, text string")
    found = alignment.alignment_rows(docs, A_PATH, B_PATH).collect()
    assert all(r.n_groups == r.n_links == len(r.same_times) + 2 and r.odd == [] and max(r.same_times) == 3 for r in found)


# ---------------------------------------------------------- fingerprints
def shingles(text):
    w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", text) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("ranges", ["1", "5", "64"])
def test_fingerprints_of_neighbours(spark, docs, clashing, ranges):
    real = spark.read.parquet(f"{SF001}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    single = [r for r in ODD + EXTRA if r[0] not in (None, 8)]
    both = spark.createDataFrame(single, SCHEMA).select("doc_id", "text").union(real).repartition(4)
    order = sorted((tuple(r) for r in both.collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = {r.doc_id: r for r in fingerprints.op12_fingerprints(both).collect()}
        repeated = fingerprints.op12_fingerprints(clashing).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(order) and len(repeated) == len(ODD + EXTRA)
    off = []
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after, r = text or "", after or "", got[doc]
        changed = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r.near_edited == fingerprints.fingerprint_likeness(r.fingerprint, r.edited_fingerprint)
        off += [r.near_edited - jaccard(text, changed), r.near_next - jaccard(text, after)]
    assert max(map(abs, off)) < 0.12 and abs(np.mean(off)) < 0.01
    marks = {}
    for r in repeated:
        assert marks.setdefault(r.doc_id if r.doc_id != 8 else (8, r.n_chars), r.fingerprint) == r.fingerprint or r.doc_id is None
    assert marks[6] == marks[7] != "" and marks[1] == marks[2] == marks[3] == ""


def test_fingerprints_of_one_and_no_row(spark):
    schema = "doc_id long, text string"
    assert fingerprints.op12_fingerprints(spark.createDataFrame([], schema)).collect() == []
    one = fingerprints.op12_fingerprints(spark.createDataFrame([(4, "ab cd ef gh ij kl")], schema)).first()
    assert (one.near_next, one.n_chars) == (1.0, 17)
    assert one.edited_sha256 == hashlib.sha256(("ab cd ef gh ij kl"[:9] + "ab cd ef gh ij kl"[:8]).encode()).hexdigest()
    alone = fingerprints.fingerprints(spark.createDataFrame([(4, "ab cd ef gh ij kl"), (None, None)], schema)).collect()
    assert {r.id: r.fingerprint for r in alone} == {4: one.fingerprint, None: ""}


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8, 0.95])
def test_likeness_is_unbiased(share):
    rng = np.random.default_rng(int(share * 100))
    found = []
    for _ in range(40):
        n = 400
        both = int(2 * n * share / (1 + share))
        word = lambda: f"w{rng.integers(1 << 60)}"
        common = [" ".join(word() for _ in range(5)) for _ in range(both)]
        texts = [common + [" ".join(word() for _ in range(5)) for _ in range(n - both)] for _ in range(2)]
        # Each unit is one shingle of its own set: the sets are joined by hashing them apart.
        sets = [fingerprints.shingle_sets(t) for t in texts]
        joined = [np.unique(np.concatenate(s)) for s in sets]
        found.append(_likeness_of_sets(*joined))
    assert abs(np.mean(found) - both / (2 * n - both)) < 0.02


def _likeness_of_sets(a, b):
    held = fingerprints.shingle_sets
    try:
        fingerprints.shingle_sets = lambda texts: [a, b]
        return fingerprints.likeness(*fingerprints.signatures(["", ""]))
    finally:
        fingerprints.shingle_sets = held


def test_densification_fills_every_bin_alike():
    matrix = np.full((3, 64), fingerprints._EMPTY)
    matrix[0, 5] = matrix[1, 5] = 7
    matrix[1, 40] = 9
    full = fingerprints.densified(matrix)
    assert (full[0] == 7).all() and set(full[1]) == {np.uint64(7), np.uint64(9)} and (full[2] == fingerprints._EMPTY).all()
    assert 10 < (full[1] == 9).sum() < 54 and full[1, 5] == 7 and full[1, 40] == 9
    for bits in (1, 2, 4, 8):
        marks = fingerprints.signatures([LONG, "a b"], bits=bits)
        again = fingerprints.unpacked(fingerprints.packed(marks[0], bits), bits)
        assert (again == marks[0]).all() and marks.max() < 1 << bits


# ---------------------------------------------------------------- search
def brute_search(docs, items, k=10):
    cut = lambda t: re.findall(ranking.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    counted = [(d, Counter(cut(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df, asked, out = Counter(t for _, c in counted for t in c), defaultdict(set), []
    for item, text in items:
        asked[item] |= set(cut(text))
    for item, terms in asked.items():
        found = []
        for doc, c in counted:
            m = 10 + (90 * sum(c.values()) * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, (doc is not None, doc), doc))
        found.sort(key=lambda f: (f[0], f[1][0], f[1][1] or 0))
        out += [(item, at + 1, f[2], -f[0]) for at, f in enumerate(found[:k])]
    return sorted(out, key=repr)


def test_search_equals_brute_force_on_odd_rows(spark, docs, clashing, monkeypatch):
    items = [(1, "Value part is FINE"), (2, None), (3, "!! ?"), (4, "terms É of the"), (4, "own line"), (None, "seven id"), (5, "nowhere_at_all"), (6, "12 34 ß")]
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    want = brute_search([r[:2] for r in ODD + EXTRA], items)
    assert rows(ranking.op13_search(docs, asked)) == want
    assert rows(ranking.op13_search(clashing, asked.withColumn("term", F.lit("x")).withColumn("shard", F.lit(1)))) == want
    none = spark.createDataFrame([], SCHEMA)
    assert ranking.op13_search(none, asked).collect() == [] == ranking.op13_search(docs, asked.limit(0)).collect()
    assert ranking.op13_search(docs.where("text is null"), asked).collect() == []


def test_search_in_small_shards_and_query_groups(spark, monkeypatch):
    """Many shards and groups of queries give the same rows as one of each."""
    docs, items = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_search([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    terms = ranking.materialise(ranking.query_terms(items), "t")
    monkeypatch.setattr(ranking, "GROUP_BYTES", 9000)
    assert rows(ranking.op13_search(docs.repartition(7), items)) == want
    assert ranking.query_groups(terms, terms.groupBy("term").agg(F.count("*").alias("df")))[1] > 1


def test_accumulators_are_limited_and_scores_exact():
    rng = np.random.default_rng(5)
    n = 4000
    found = {"rare": (np.sort(rng.choice(n, 30, replace=False)), rng.integers(1, 4, 30))}
    for t, share in (("some", 0.1), ("many", 0.5), ("most", 0.9)):
        at = np.flatnonzero(rng.random(n) < share)
        found[t] = at, rng.integers(1, 5, len(at))
    lengths = rng.integers(50, 500, n)
    terms = [(len(found[t][0]), t) for t in found]
    limited = ranking.Searcher(lengths, found, n, int(lengths.sum()))
    at, score = limited.scores(terms, 5)
    free = ranking.Searcher(lengths, found, n, int(lengths.sum()))
    every, exact = free.scores(terms, n + 1)
    exact = dict(zip(every.tolist(), exact.tolist()))
    best = sorted(exact.items(), key=lambda x: (-x[1], x[0]))[:5]
    got = sorted(zip(at.tolist(), score.tolist()), key=lambda x: (-x[1], x[0]))[:5]
    assert got == best and limited.made < free.made and limited.read < free.read
    assert all(exact[d] == s for d, s in zip(at.tolist(), score.tolist()))
