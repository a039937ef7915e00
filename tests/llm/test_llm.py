"""Operators of the llm subpackage against plain Python on small tables, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cityflow.llm import embeddings, exact_mphf, forest, gam, langid, mixing, packing, queries, templates, units, warc
from cityflow.llm.components import connected_components
from cityflow.llm.hnsw import Graph, audit, range_pairs
from cityflow.llm.shingles import shingle_sets
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is that for it was on with as by at from this have not are but".split()


def words(n, seed):
    rng = random.Random(seed)
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]


LONG = " ".join(words(60_000, 1))
ODD = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t", "en", "a", 3), (None, "no id here at all today", "en", "a", None),
       (None, None, None, None, None), (4, "12 34 !!", "de", "b", 8), (5, "ß", "de", None, 1), (6, LONG, "en", "b", len(LONG)), (7, LONG, "en", "b", len(LONG)),
       (8, "one two three four five six seven", "en", "a", 33), (8, "one two three four five six seven", "en", "a", 33),
       (8, "another text of the same id as before", "en", "a", 37), (9, "Value 17 of part 3 is fine", "en", "c", 1), (10, "Value 99 of part 8 is fine", "en", "c", 1),
       (11, "Value 5 of part 77 is fine\nown line that nobody else has at all", "en", "c", 1), (12, "<|endoftext|> as plain text", "en", "c", 1)]
#: Names the operators use for columns of their own.
CLASHES = ["id", "digest", "text_hash", "dropped", "gone", "part", "copy", "order_key", "n_lines", "n_dropped", "lang_pred", "lang_score",
           "lang_rejected", "removed_spans", "kept_spans", "rate", "weight", "block", "rank", "length", "start", "held_out", "score", "hit", "bucket"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ WARC
def test_warc_round_trip_segments_and_revisits(spark, scratch):
    big = b"\x00\r\n\r\nWARC/1.1\r\n" * 50_000
    data = [(5, "u", big), (3, "u\n", big), (9, None, big), (1, "", b""), (2, "v", b"x" * 99), (4, "v", b"x" * 99), (3, "u", big), (None, "n", big)]
    df = spark.createDataFrame(data, "id long, uri string, payload binary")
    path = f"file://{scratch}/w"
    warc.write_warc(warc.with_revisits(df), path, segment_bytes=100_000)
    chunks = warc.read_warc(spark, path, chunk_bytes=7_000)
    sha = hashlib.sha256(big).hexdigest()
    got = rows(warc.record_table(chunks).select("id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    x, e = hashlib.sha256(b"x" * 99).hexdigest(), hashlib.sha256(b"").hexdigest()
    assert got == sorted([(3, len(big), sha, "response", None), (3, len(big), sha, "response", None), (None, len(big), sha, "response", None),
                          (5, len(big), sha, "revisit", 3), (9, len(big), sha, "revisit", 3), (1, 0, e, "response", None),
                          (2, 99, x, "response", None), (4, 99, x, "response", None)], key=repr)
    one = chunks.where("record_id = '<urn:record:null>'").orderBy("chunk_no").collect()
    assert b"".join(r.chunk for r in one) == big and max(r.size for r in one) <= 7_000 and [r.is_last for r in one[:-1]] == [False] * (len(one) - 1)
    upto = one[3].offset + one[3].size
    assert one[3].running_sha256 == hashlib.sha256(big[:upto]).hexdigest()


def test_warc_query_edge_cases(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", "ä" * 200), (4, "u", "ä" * 200)], "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.op1_warc(pages.withColumn("digest", F.lit(1))).collect()}
    assert got == {1: (0, "response", None), 2: (0, "response", None), 3: (400, "response", None), 4: (400, "revisit", 3)}
    assert warc.op1_warc(pages.limit(0)).count() == 0


# ------------------------------------------------------------------ line templates
def test_templates_drop_recurring_lines_and_keep_the_first(odd, empty, clashing):
    out = {(r.doc_id, r.text): r.n_dropped for r in templates.drop_recurring(odd).collect()}
    # 9 is the first of the three documents of the template; 10 and 11 lose the line.
    assert out[(9, "Value 17 of part 3 is fine")] == 0 and out[(10, "")] == 1
    assert out[(11, "own line that nobody else has at all")] == 1
    assert sum(out.values()) == 2 and templates.drop_recurring(empty).count() == 0
    kept = templates.drop_recurring(clashing)
    assert kept.count() == len(ODD) and sorted(kept.columns) == sorted([*clashing.columns])


def test_templates_generalise_positions_beyond_digits(spark):
    docs = [(i, f"user {n} logged in from host somewhere today") for i, n in enumerate(["anna", "bert", "carl", "dora"])]
    docs.append((9, "user wrote this line quite differently from all the others"))
    got = {r.doc_id: r.n_dropped for r in templates.drop_recurring(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 9: 0}  # the name is a leading token, so these are different leaves
    docs = [(i, f"login at the host by {n} was fine today") for i, n in enumerate(["anna", "bert", "carl", "dora"])]
    got = {r.doc_id: r.n_dropped for r in templates.drop_recurring(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1}


def test_templates_of_short_lines(spark):
    data = [(i, f"All rights reserved.\n\nown line of {w}\nLes.\nPage {i}") for i, w in enumerate("abc")] + [(7, "rights reserved.")]
    got = {r.doc_id: r.text for r in templates.drop_recurring(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    # "own line of <w>" is one template too.
    assert got == {0: data[0][1], 1: "", 2: "", 7: "rights reserved."}


def test_templates_of_one_leaf(spark):
    drop = lambda lines: {r.doc_id: r.n_dropped for r in templates.drop_recurring(
        spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()}
    one = [f"login at the desk for {w} failed again" for w in "abcdefghij"]
    two = [f"login at the host by {w} was fine" for w in "klmn"]
    assert drop(one + two) == {i: int(i not in (0, 10)) for i in range(14)}
    # The modal tokens are a blend that no line matches.
    mixed = [f"a b c {w} {w}1x {w}q {w}r {x}" for w in ("dog", "cat", "cow", "hen") for x in ("one", "two", "six")]
    assert drop(mixed) == {i: int(i % 3 > 0) for i in range(12)}


def test_many_templates_of_one_leaf_take_few_rounds(spark, monkeypatch):
    rounds, judged = [], templates._judged
    monkeypatch.setattr(templates, "_judged", lambda *args: rounds.append(1) or judged(*args))
    names = [a + b for a in "bcdfgh" for b in "aeiouy"]
    lines = [f"job run for {t} by {t}{k} was {t}q {t}r ok" for t in names for k in ("x", "xx", "xxx")]
    got = {r.doc_id: r.n_dropped for r in templates.drop_recurring(
        spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()}
    assert got == {i: int(i % 3 > 0) for i in range(len(lines))} and len(rounds) <= 3


def brute_templates(data, least=3):
    """(id, lines dropped, text) of every row: leaves by token count and leading tokens, modal templates in rounds, splits."""
    def masked(line):
        line = re.sub("[ \t\r\f\x0b]+", " ", line).strip(" ")
        return " ".join("<*>" if re.search("[0-9]", t) else t for t in line.split(" "))
    leaves, places = defaultdict(lambda: defaultdict(Counter)), {}
    for doc, text in dict.fromkeys(data):
        for pos, line in enumerate(text.split("\n") if text is not None else []):
            if m := masked(line):
                tokens = tuple(m.split(" "))
                leaf = (len(tokens), tokens[:3])
                leaves[leaf][tokens][doc] += data.count((doc, text))
                places.setdefault((doc, text), []).append((pos, leaf, tokens))
    names = {}
    for leaf, lines in leaves.items():
        if len(lines) < 2 or sum(map(len, lines.values())) < least:
            continue
        groups, number = [set(lines)], 0
        while groups:
            group = groups.pop()
            # Sightings count rows, as often as a line stands in them.
            if len(group) < 2 or sum(sum(lines[x].values()) for x in group) < least:
                continue
            counts = [Counter(x[k] for x in group) for k in range(leaf[0])]
            modal = [min(c.items(), key=lambda e: (-e[1], e[0]))[0] for c in counts]
            joins = {x for x in group if sum(a == b for a, b in zip(x, modal)) * 10 >= leaf[0] * templates.SIMILAR_TENTHS}
            for x in joins:
                names[leaf, x] = ("template", number)
            number += 1
            if len(joins) * templates.STAY_SHARE >= len(group):
                groups.append(group - joins)
            else:
                odd = [(max(c.values()), -k) for k, c in enumerate(counts) if 1 < max(c.values()) < len(group)]
                if odd:
                    at = -max(odd)[1]
                    groups += [{x for x in group - joins if x[at] == token} for token in counts[at]]
    spread = defaultdict(set)
    for (doc, _), found in places.items():
        for _, leaf, line in found:
            spread[leaf, names.get((leaf, line), line)].add(doc)
    out = []
    for doc, text in data:
        gone = {pos for pos, leaf, line in places.get((doc, text), []) for docs in [spread[leaf, names.get((leaf, line), line)]]
                if len(docs) >= least and doc != min(docs)}
        lines = text.split("\n") if text is not None else []
        out.append((doc, len(lines), len(gone), None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return sorted(out, key=repr)


def test_templates_equal_brute_force(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    data += [(1000 + i, "\n".join(f"login at the {a} by {b}{i % 3} was {c}" for a in ("desk", "host") for b in ("x", "anna") for c in ("fine", "denied", f"row {i}")))
             for i in range(9)] + [(1000, "login at the desk by x0 was fine\n\n a  b\t7 "), (2000, None), (2001, "")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert rows(templates.op2_line_dedup(df)) == brute_templates(data)


# ------------------------------------------------------------------ mixing
def test_mixing_inverts_the_poisson_distribution(spark, odd, empty, clashing):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3600, "big").otherwise("small").alias("source"))
    rates = mixing.target_rates(docs, {"big": 0.5, "small": 0.5})
    assert {r.source: round(r.rate, 6) for r in rates.collect()} == {"big": round(2000 / 3600, 6), "small": 5.0}
    out = mixing.replicate(docs, rates)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["big"] - 2000) < 200 and abs(n["small"] - 2000) < 200
    assert rows(out) == rows(mixing.replicate(docs.repartition(7), rates))  # no dependence on partitions
    huge = mixing.replicate(docs.where("doc_id = 0"), spark.createDataFrame([("big", 5000.0)], "source string, rate double"))
    assert abs(huge.count() - 5000) < 400 and huge.select("order_key").distinct().count() == huge.count()
    assert mixing.replicate(odd, mixing.target_rates(odd, {None: 1.0})).where("source is not null").count() == 0
    assert mixing.replicate(empty, mixing.target_rates(empty)).count() == 0
    assert set(mixing.replicate(clashing, mixing.target_rates(clashing)).columns) == set(clashing.columns)
    assert mixing.replicate(odd, mixing.target_rates(odd, {})).count() == 0


# ------------------------------------------------------------------ quality
def test_additive_model_learns_an_interaction_and_scores_every_row(spark, odd, empty):
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:2000], y[:2000], rounds=20)
    assert (0, 1) in model.pairs and ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = gam.op4_quality(odd, none).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5} and gam.op4_quality(empty, none).count() == 0
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 13)] + [(3, None), (None, 1), (4, 0)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in gam.op4_quality(odd, labels).collect())
    extra = [F.lit("x").alias(c) for c in (*CLASHES, "features", "y", "predicted", "quality")]
    assert rows(gam.op4_quality(odd.select("*", *extra), labels)) == rows(gam.op4_quality(odd, labels))


def test_repetition_features_read_whole_texts():
    """A word is distinct once however long the text is, and repeats across any distance count."""
    once = [f"w{i}" for i in range(6000)]
    at = {f: gam.FEATURES.index(f) for f in ("distinct_words", "top_word", "same_next")}
    alone, twice = gam.text_features(" ".join(once)), gam.text_features(" ".join(once + once))
    assert alone[at["distinct_words"]] == 1 and twice[at["distinct_words"]] == 0.5
    assert twice[at["top_word"]] == 2 / 12000 and twice[at["same_next"]] == 0
    assert gam.text_features(" ".join(once + once[-1:]))[at["same_next"]] == 1 / 6001


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = queries.op4_quality(spark, sf).join(labels, "doc_id").where("held_out")
    assert out.where("predicted = quality").count() >= 0.95 * out.count()


# ------------------------------------------------------------------ units
@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_units_keep_the_earliest_and_the_offsets(spark, unit):
    gap = "\n" if unit == "line" else "\n\n"
    a, b, c = (" ".join(words(12, s)) for s in (1, 2, 3))
    data = [(2, gap.join([a, b, "short"])), (1, gap.join(["x", a.upper(), c])), (3, gap.join([b, a])), (4, None), (5, ""), (6, a + gap + a), (None, c),
            (7, gap.join(["tail", c])), (7, gap.join(["tail", c]))]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("gone", F.lit(1))
    got = defaultdict(list)
    for r in units.remove_repeats(df, unit).collect():
        got[r.doc_id].append(r)
    assert got[1][0].text == data[1][1] and got[2][0].text == gap.join([b, "short"]) and got[3][0].text == ""
    assert got[4][0].text is None and got[5][0].text == "" and got[6][0].text == "" and got[None][0].text == ""
    assert [r.text for r in got[7]] == ["tail", "tail"]
    span = got[2][0].removed_spans[0]
    assert data[0][1][span.start:span.end] == a
    assert units.remove_repeats(df.limit(0), unit).count() == 0


def test_units_on_odd_rows(odd, clashing):
    out = units.remove_repeats(odd).collect()
    assert len(out) == len(ODD) and Counter(r.text for r in out)[LONG] == 1  # 7 repeats the long text of 6
    assert units.remove_repeats(clashing).count() == len(ODD)


def test_units_of_any_length_are_compared(spark):
    data = [(1, "All rights reserved.\n\nown\n \nLes."), (2, "les.\n\nAll  rights reserved.\n \nother"), (3, "Les."), (4, "\n\n")]
    got = {r.doc_id: (len(r.removed_spans), r.text) for r in units.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    # Empty lines are no units and stay.
    assert got == {1: (0, data[0][1]), 2: (2, "\n \nother"), 3: (1, ""), 4: (0, "\n\n")}


def brute_sentences(data, least):
    """(id, removed spans, short repeats, text) of every row: sentences and lines, earliest stays, runs of repeats go."""
    cut = re.compile(r"\n|(?<=[.!?])[ \t\r\f\x0b]+")
    parts, first = [], {}
    for doc, text in data:
        at, own = 0, []
        for gap in [(m.start(), m.end()) for m in cut.finditer(text or "")] + [(len(text or ""),) * 2]:
            own.append((at, *gap, " ".join((text or "")[at:gap[0]].lower().split())))
            at = gap[1]
        parts.append([u for u in own if u[3]])
        for start, _, _, norm in parts[-1]:
            rank = (doc is None, doc or 0, start, text)
            first[norm] = min(first.get(norm, rank), rank)
    out = []
    for (doc, text), own in zip(data, parts):
        again = [first[u[3]] != (doc is None, doc or 0, u[0], text) for u in own]
        gone, short, i = [], 0, 0
        while i < len(own):
            j = i
            while j < len(own) and again[j]:
                j += 1
            if sum(len(u[3].split()) for u in own[i:j]) >= least:
                gone += own[i:j]
            else:
                short += j - i
            i = max(j, i + 1)
        kept = [] if text is None else list(text)
        for start, _, resume, _ in gone:
            kept[start:resume] = [""] * (resume - start)
        left = None if text is None else "".join(kept)
        if gone and gone[-1][1] == len(text) and left.endswith("\n"):
            left = left[:-1]
        out.append((doc, [(u[0], u[1]) for u in gone], short, left))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [1, 12, 30])
def test_repeated_runs_of_sentences_equal_brute_force(spark, odd, clashing, least):
    passage = " ".join(" ".join(words(9, s)).capitalize() + ("!" if s % 2 else ".") for s in range(40, 48))
    own = lambda s: " ".join(words(15, s)).capitalize() + "."
    data = [r[:2] for r in ODD if r[0] not in (None, 8)]
    data += [(100, own(1) + " " + passage + " " + own(2)), (101, own(3) + "\n\n" + passage.upper() + "\n" + own(4)),
             (102, own(5) + " " + " ".join(passage.split()[:18]) + " " + own(6)), (103, passage + "  " + own(7) + "\n" + passage), (104, own(1) + " no. end")]
    data += [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id") + 1000, "text").collect()]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = units.remove_repeats(df, "sentence", min_run_words=least)
    assert sorted(((r.doc_id, [tuple(s) for s in r.removed_spans], r.n_short_repeats, r.text) for r in got.collect()), key=repr) == brute_sentences(data, least)
    found = {r.doc_id: r for r in units.op5_unit_dedup(df).collect()}
    assert [found[d].n_removed for d in range(100, 105)] == [0, 8, 0, 16, 0] and found[102].n_short_repeats == 2
    for name in ("__again", "__cut", "__id", "__hash", "__0"):
        assert units.remove_repeats(clashing.withColumn(name, F.lit("x")), "sentence").count() == len(ODD)


# ------------------------------------------------------------------ exact dedup
def brute_exact(data):
    norm = lambda t: "".join(ch for ch in t or "" if ch not in " \t\n\x0b\x0c\r")
    groups = defaultdict(list)
    for doc, text, *_ in data:
        groups[norm(text)].append((doc, len(text or "")))
    out = []
    for doc, text, *_ in data:
        g = groups[norm(text)]
        best = sorted(g, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[0][0]
        out.append((doc, best, len(g), doc == best, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup_equals_brute_force(odd, empty, clashing, spark):
    assert rows(exact_mphf.op6_exact_dedup(odd)) == brute_exact(ODD) == rows(exact_mphf.op6_exact_dedup(clashing))
    assert exact_mphf.op6_exact_dedup(empty).count() == 0
    data = [(i, f"text {i % 700}" + " " * (i % 3)) for i in range(2000)]
    assert rows(exact_mphf.op6_exact_dedup(spark.createDataFrame(data, "doc_id long, text string"))) == brute_exact(data)
    ends = [(-2**63, "end"), (2**63 - 1, "end"), (0, " end"), (-2**63, "low"), (None, "low"), (5, "other")]
    assert rows(exact_mphf.op6_exact_dedup(spark.createDataFrame(ends, "doc_id long, text string"))) == brute_exact(ends)


def test_history_and_new_rows_share_groups(spark):
    """Groups within the past, within the new rows and across both; the winner on either side."""
    rng = random.Random(8)
    data = [(i, rng.choice("abcdefgh") * rng.randint(1, 2) + " " * rng.randint(0, 3)) for i in range(60)] + [(i, f"only {i}") for i in range(100, 120)]
    frame = exact_mphf.digest_rows(spark.createDataFrame(data, "doc_id long, text string"))
    want = [(d, k, n, kept) for d, k, n, kept, _ in brute_exact(data)]
    for past in ("id % 2 = 0", "id < 30", "true", "false"):
        marked = frame.withColumn("past", F.expr(past))
        index = exact_mphf.materialise(exact_mphf.build_index(exact_mphf.winners(marked.where("past"))), "index")
        got = exact_mphf.dedup_with_past(marked, index)
        assert rows(got.select("id", "keep_id", "group_size", "kept")) == sorted(want, key=repr)
        hits = exact_mphf.lookup(marked, index).where("hit is null").count()
        assert hits == (80 if past == "false" else marked.where("not past").join(marked.where("past"), "digest", "left_anti").count())


def test_perfect_hash_is_minimal_and_rejects_others(spark):
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 40):
        assert sorted(exact_mphf.place_bucket(rng.integers(0, 1 << 60, n))[3].tolist()) == list(range(n))
    frame = lambda ids: spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    index = exact_mphf.build_index(exact_mphf.winners(exact_mphf.digest_rows(frame(range(500)))))
    batch = spark.createDataFrame([(1000 + i, f"t{i}") for i in range(490, 510)] + [(2000, "t505 ")], "doc_id long, text string")
    got = {r.id: (r.keep_id, r.group_size) for r in exact_mphf.dedup(exact_mphf.digest_rows(batch), index).collect()}
    assert got[1490] == (490, 1) and got[1504] == (1504, 1) and got[1505] == (2000, 2) and got[2000] == (2000, 2)


# ------------------------------------------------------------------ components, embeddings
def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(f"{rng.randrange(300):03d}", f"{rng.randrange(300):03d}") for _ in range(220)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(90)] + [("z", "z"), ("a", None)]
    root = {}

    def find(v):
        root.setdefault(v, v)
        return v if root[v] == v else find(root[v])
    for a, b in edges:
        if b is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {v: find(v) for v in list(root)}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_graph_search_reaches_recall(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 32))
    x = centres[rng.integers(0, 40, 1500)] + rng.normal(size=(1500, 32)) * 0.12
    x /= np.linalg.norm(x, axis=1)[:, None]
    truth = x @ x.T >= 0.98
    found = range_pairs(Graph.unpack(x, Graph(x).pack()), x, x, 0.98, 64)
    assert not (found & ~truth).any() and (found & truth).sum() >= 0.99 * truth.sum()


class BlindGraph(Graph):
    """Finds hot rows only, until the beam is wide."""
    hot = 0

    def search(self, q, beam):
        rows = np.arange(len(self.x) if beam >= 256 else self.hot)
        sims = q @ self.x[rows].T
        top = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        pad = ((0, 0), (0, max(0, beam - len(rows))))
        return np.pad(rows[top], pad, constant_values=-1), np.pad(np.take_along_axis(sims, top, 1), pad, constant_values=-np.inf)


def test_recall_is_measured_on_sparse_links_and_beside_a_hot_group():
    rng = np.random.default_rng(4)
    near = lambda rows: rows + rng.normal(size=rows.shape) * 0.005
    unit = lambda rows: rows / np.linalg.norm(rows, axis=1)[:, None]
    x = rng.normal(size=(1500, 32))
    x[:600] = near(np.repeat(x[:1], 600, axis=0))
    x[900:940] = near(x[600:640])  # a hot group beside 40 groups of two
    x = unit(x)
    graph = BlindGraph.unpack(x, Graph(x).pack())
    graph.hot = 600
    blind = audit(graph, x, x, 0.98, (64, 256), np.arange(1500))
    # 80 queries of small groups find nothing at the narrow beam, 600 of the hot group all of theirs.
    assert blind.tolist() == [[[80, 0], [600, 600]], [[80, 80], [600, 600]]]
    real = audit(Graph(x), x, x, 0.98, (64,), np.arange(1500))
    assert real[0, 0, 1] >= 0.99 * 80 and real[0, 1, 1] >= 0.99 * 600


def test_beam_widens_until_each_label_and_the_pool_reach_recall(spark):
    audits = [("a", 4, b, 0, 100, f) for b, f in zip(embeddings.BEAMS, (80.0, 95.0, 99.5, 100.0, 100.0, 100.0))]
    audits += [("b", 4, b, 0, 2, 2.0) for b in embeddings.BEAMS] + [("c", 4, b, 0, 0, 0.0) for b in embeddings.BEAMS]
    audits += [("d", 4, b, 1, 10, f) for b, f in zip(embeddings.BEAMS, (9.0, 9.0, 9.0, 9.0, 9.0, 9.5))]
    frame = lambda rows: spark.createDataFrame(rows, "label string, dims int, beam int, kind int, queries long, found double")
    beams = {r.label: r.beam for r in embeddings.chosen_beams(frame([a if a[0] != "d" else (*a[:5], 10.0) for a in audits]), 0.99).collect()}
    assert beams == {"a": 256, "b": 256, "c": 256, "d": 256}
    assert {r.label: r.beam for r in embeddings.chosen_beams(frame(audits), 0.99).collect()}["b"] == embeddings.BEAMS[-1]


def test_links_come_from_searches_of_the_graphs(spark, monkeypatch):
    """On sparse tables too, every meeting of a graph with queries searches the graph, and hardly a row is compared otherwise."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    near = table.where("vec_id % 9 = 0").select("vec_id", "label", F.transform("embedding", lambda v, i: v + (i % 3 - 1) * 0.003).alias("embedding"))
    rows_ = embeddings.unit_rows(table.select("vec_id", "label", "embedding").union(near), "vec_id", "embedding", "label").where("digest is not null")
    classes = rows_.groupBy("label", "dims", "digest").agg(F.count("*").alias("weight"), F.first("unit").alias("unit"))
    monkeypatch.setattr(embeddings, "SHARD_ROWS", 80)
    shards = embeddings.build_shards(classes).cache()
    audits = embeddings.audited_beams(shards, 0.98)
    measured = audits.where("beam = 64").agg(F.sum("queries"), F.sum("found")).first()
    assert measured[0] > 100 and measured[1] >= 0.99 * measured[0]
    frames = shards.toPandas()
    searched = []
    search = Graph.search
    monkeypatch.setattr(Graph, "search", lambda self, q, beam: searched.append(len(q)) or search(self, q, beam))
    met = 0
    for label, part in frames.groupby("label"):
        part = part.assign(beam=64)
        for row in part.itertuples():
            x = embeddings._matrix([row.units], row.dims)
            for q in part.rename(columns={"shard": "q_shard", "digests": "q_digests", "weights": "q_weights", "units": "q_units"}).itertuples():
                if q.q_shard >= row.shard:
                    before = len(searched)
                    embeddings._links_of(row, Graph.unpack(x, row.graph), x, q, 0.98)
                    assert len(searched) > before
                    met += 1
    assert met > 40
    shards.unpersist()


def test_embeddings_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SHARD_ROWS", 40)  # several shards of a label
    rng = np.random.default_rng(2)
    data = []
    for i in range(240):
        base = rng.normal(size=16) if i % 3 else np.ones(16)
        data.append((i, [float(v) for v in base + rng.normal(size=16) * 0.03], i % 2))
    data += [(300, data[1][1], data[1][2]), (301, [v * 7 for v in data[1][1]], data[1][2]), (302, data[1][1], None), (303, None, 0), (304, [0.0] * 16, 0),
             (305, [float("nan")] * 16, 0), (306, [None] * 16, 0), (307, [], 0), (308, [1.0, 2.0], 0), (309, [1.0, 2.0], 0), (310, [1e300] * 16, 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("unit", F.lit(1))
    good = lambda v, lab: lab is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)
    links = defaultdict(set)
    for i, v, la in data:
        for j, w, lb in data:
            if i != j and good(v, la) and good(w, lb) and la == lb and len(v) == len(w):
                a, b = np.array(v) / max(map(abs, v)), np.array(w) / max(map(abs, w))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    links[i].add(j)
    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        return min(seen)
    want = sorted(((i, len(links[i]), reach(i), reach(i) == i) for i, *_ in data), key=repr)
    assert rows(embeddings.op7_embeddings(df).select("vec_id", "n_links", "component_id", "kept")) == want
    assert embeddings.op7_embeddings(df.limit(0)).count() == 0


# ------------------------------------------------------------------ language
def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op8_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.where("lang = lang_pred").count() >= 0.98 * out.count()


def test_language_rejects_documents_of_an_unlearned_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.train(docs.where("lang <> 'es'"))
    rng = random.Random(9)
    letters = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(120))
    junk = spark.createDataFrame([(-1 - i, letters(), None) for i in range(100)], "doc_id long, text string, lang string")
    some = docs.where(langid.held_out("doc_id")).select("doc_id", "text", "lang").unionAll(junk)
    kind = F.when(F.col("lang").isNull(), "junk").when(F.col("lang") == "es", "unlearned").otherwise("learned")
    got = langid.identify(some, model).groupBy(kind.alias("kind")).agg(F.avg(F.col("lang_rejected").cast("int")).alias("r"))
    share = {r.kind: r.r for r in got.collect()}
    print(share)
    assert share["unlearned"] > 0.9 and share["junk"] == 1 and share["learned"] < 0.04


def test_language_edge_cases(odd, empty, clashing):
    model = langid.train(odd)
    got = langid.identify(odd, model).collect()
    assert len(got) == len(ODD)
    for r in got:
        letters = any(ch.isalpha() for ch in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or (r.lang_rejected and r.lang_score == 0))
    assert {r.lang_pred for r in langid.identify(odd, langid.LangModel()).collect()} == {"und"}
    assert langid.train(empty).langs == [] and langid.op8_langid(empty).count() == 0
    assert set(langid.identify(clashing, model).columns) == set(clashing.columns)


def test_language_logits_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    model = langid.LangModel(["a", "b"], rng.normal(size=(1 << langid.BITS, langid.DIM)).astype(np.float32), rng.normal(size=(langid.DIM, 2)).astype(np.float32), np.zeros(2))
    raw = [" ".join(words(50, s)).encode() for s in range(20)]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    whole = model.logits(data, ends - [len(r) for r in raw], ends)
    alone = np.vstack([model.logits(np.frombuffer(r, np.uint8), np.array([0]), np.array([len(r)])) for r in raw])
    assert np.allclose(whole, alone)
    counts = [langid.subword_counts(r.decode()) for r in raw]
    monkeypatch.setattr(langid, "PIECE_BYTES", 61)  # texts of many pieces have the same subwords
    assert np.allclose(model.logits(data, ends - [len(r) for r in raw], ends), whole, atol=1e-6)
    for r, (buckets, n) in zip(raw, counts):
        again = langid.subword_counts(r.decode())
        assert (again[0] == buckets).all() and (again[1] == n).all()
    # More languages than the embedding is wide: sums of embeddings instead of sums of logits.
    many = langid.LangModel([str(i) for i in range(40)], model.embed, rng.normal(size=(langid.DIM, 40)).astype(np.float32), np.zeros(40))
    flat = np.frombuffer(raw[0], np.uint8)
    buckets, n = counts[0]
    assert np.allclose(many.logits(flat, np.array([0]), np.array([len(flat)]))[0], (n / n.sum()) @ model.embed[buckets] @ many.weight, atol=1e-5)


def test_language_of_many_noisy_tags(spark):
    """Thousands of language tags share the sample; frequent languages are still told apart."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    noisy = spark.range(5000).select((F.col("id") + 10**6).alias("doc_id"), F.concat(F.lit("noise text "), "id").alias("text"), F.concat(F.lit("tag"), "id").alias("lang"))
    model = langid.train(docs.limit(2000).union(noisy), rows_in_all=600)
    assert 100 < len(model.langs) < 900 and model.weight.shape == (langid.DIM, len(model.langs))
    got = langid.identify(docs.limit(50), model).collect()
    assert len(got) == 50 and all(0 <= r.lang_score <= 1 for r in got)


# ------------------------------------------------------------------ Jaccard join
def brute_jaccard(data, similarity=0.8):
    def shingles(t):
        w = [x for x in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if x]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = [shingles(t) for _, t in data]
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and len(a & b) >= similarity * len(a | b) - 1e-9:
                links[i].add(j)
    out = []
    for i, (doc, _) in enumerate(data):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [data[k][0] for k in seen if data[k][0] is not None]
        out.append((doc, min(ids) if ids else None, len(links[i])))
    return sorted(out, key=repr)


def near_copies():
    rng, data = random.Random(4), []
    for g in range(12):
        base = words(60 + 5 * g, 100 + g)
        for k in range(8):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = "changed" + str(rng.randrange(99))
            data.append((100 * g + k, " ".join(own[:len(own) - rng.randrange(4)])))
    return data


@pytest.mark.parametrize("members", [512, 5])
def test_jaccard_classes_equal_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(forest, "BLOCK_MEMBERS", members)
    data = near_copies() + [(5000, None), (5001, ""), (5002, " \n"), (5003, "a b"), (5004, "a b"), (5005, "a  b\n"), (5003, "a b"), (5006, LONG), (5007, LONG + " more")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("digest", F.lit("x"))
    assert rows(forest.op9_jaccard(df).select("doc_id", "class_id", "n_links")) == brute_jaccard(data)


def test_jaccard_edge_cases(odd, empty, clashing):
    want = brute_jaccard([(d, t) for d, t, *_ in ODD])
    assert rows(forest.op9_jaccard(odd).select("doc_id", "class_id", "n_links")) == want
    assert forest.op9_jaccard(empty).count() == 0 and forest.keep_one(empty).count() == 0
    kept = forest.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert Counter(r.text for r in kept.collect())[LONG] == 1


def test_audit_shortens_prefixes_until_sampled_pairs_meet(spark, monkeypatch):
    data = near_copies()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(forest, "prefix_length", lambda *a: 8)  # far too long for four tries
    lengths, sign = [], forest.signatures
    monkeypatch.setattr(forest, "signatures", lambda *a: lengths.append(a[4]) or sign(*a))
    # The sample holds all these documents, so every pair is audited.
    got = forest.jaccard_classes(df, tries=4).select("id", "class_id", "n_links")
    assert rows(got) == brute_jaccard(data) and lengths[0] == 8 and lengths == list(range(8, lengths[-1] - 1, -1)) and len(lengths) > 2


def test_sampled_sets_know_their_partners():
    sets = [np.unique(np.random.default_rng(i).integers(0, 50, 40).astype(np.uint64)) for i in range(30)]
    sample = forest.Sample({bytes([i]): s for i, s in enumerate(sets[:12])})
    for i, s in enumerate(sets):
        want = [bytes([k]) for k in range(12) if k != i and len(np.intersect1d(s, sets[k])) >= 0.5 * len(np.union1d(s, sets[k]))]
        assert sample.near(s, bytes([i]), 0.5) == want
    assert forest.Sample({}).near(sets[0], b"x", 0.5) == []


def test_blocks_of_a_large_group_stay_small(spark, monkeypatch):
    """A large group of near copies is cut into blocks; the rows made are bucket and block pairs, far fewer than pairs of copies."""
    monkeypatch.setattr(forest, "BLOCK_MEMBERS", 20)
    base = words(120, 77)
    data = [(i, " ".join(base[:i % 60] + [f"own{i}"] + base[i % 60 + 1:])) for i in range(300)] + [(1000 + i, " ".join(words(50, 500 + i))) for i in range(50)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    assert rows(forest.jaccard_classes(df).select("id", "class_id", "n_links")) == brute_jaccard(data)
    signed = forest.signatures(df, "doc_id", "text", 24, 5)
    classes = signed.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("weight"), F.first("size").alias("size"), F.first("prefixes").alias("prefixes"))
    placed, pairs = forest.met_blocks(classes)
    assert placed.groupBy("block").count().agg(F.max("count")).first()[0] < 60 and placed.where("rep >= 1000").count() == 0
    assert pairs.count() < 300 * 299 / 2 / 20


def test_shingles_of_long_texts_do_not_depend_on_pieces():
    text = LONG * 4
    w = text.split()
    assert len(shingle_sets([text])[0]) == len({tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    assert (shingle_sets(["x", text, ""])[1] == shingle_sets([text])[0]).all()
    assert forest.prefix_length(0.8, 24, 0.9999) == 5


# ------------------------------------------------------------------ packing
def check_pieces(pieces, texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for t in texts]
    want = Counter((s, len(x[s:s + 2048]), zlib.crc32(x[s:s + 2048].tobytes()), len(x)) for x in ids for s in range(0, len(x), 2048))
    assert Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces) == want
    at = defaultdict(list)
    for r in pieces:
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048
    return len(at)


def test_packing_edge_cases(odd, empty, clashing):
    texts = [t for _, t, *_ in ODD]
    check_pieces(packing.op10_packing(odd, queries.tokenizer_path()).collect(), texts)
    check_pieces(packing.op10_packing(clashing, queries.tokenizer_path()).collect(), texts)
    assert packing.op10_packing(empty, queries.tokenizer_path()).count() == 0


def test_packing_is_dense(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = packing.op10_packing(docs, queries.tokenizer_path()).collect()
    n = check_pieces(out, [r.text for r in docs.select("text").collect()])
    assert sum(r.length for r in out) > 0.99 * 2048 * (n - 1)


def test_histogram_packing_depends_on_lengths_only():
    runs, n = packing.pack_histogram({1000: 10**9, 48: 10**9, 3: 7}, 2048)
    assert int((runs.packs).sum()) == 2 * 10**9 + 7 and len(runs) < 50 and n >= 5 * 10**8


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages_on_odd_tables(spark, clashing, odd, empty, scratch):
    docs, none = clashing, empty
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got, gone = stage(spark, docs, scratch), stage(spark, none, scratch)
        assert gone.count() == 0, name
        if k + 1 < len(corpus_pipeline.STAGES):
            assert got.columns == docs.columns and gone.columns == none.columns, name
            docs = spark.createDataFrame(got.collect(), got.schema)
    texts = [r.text for r in docs.select("text").collect()]
    check_pieces(got.collect(), texts)


def test_pipeline_decisions_equal_plain_python(spark, scratch):
    junk = [(7000, None), (7001, "!!! 123"), (7002, "")]
    boiler = [(2000 + i, " ".join(words(30, 900 + i)) + "\nPage 1%d of this document was printed today" % i) for i in range(5)]
    data = near_copies() + junk + boiler
    df = spark.createDataFrame([(d, t, "en", "a", len(t or "")) for d, t in data], SCHEMA)
    one = corpus_pipeline.language_id(spark, df, scratch)
    assert {r.doc_id for r in df.collect()} - {r.doc_id for r in one.collect()} == {7000, 7001, 7002}
    two = corpus_pipeline.line_dedup(spark, one, scratch)
    lines = {r.doc_id: (r.text, r.n_chars) for r in two.collect()}
    assert "printed" in lines[2000][0] and all("printed" not in lines[2000 + i][0] and lines[2000 + i][1] == len(lines[2000 + i][0]) for i in range(1, 5))
    three = corpus_pipeline.near_duplicates(spark, two, scratch)
    best = {c for _, c, _ in brute_jaccard([(d, t) for d, (t, _) in lines.items()])}
    assert {r.doc_id for r in three.collect()} == best
