"""Line deduplication with a log-template tree, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import materialise
from cityflow.llm.common_lines import LINE_SPACE, lines_of, without_lines

#: Leading tokens on the path to a leaf (a shorter line is its own path). Every line that is not empty enters the tree.
DEPTH = 3
#: A line belongs to its leaf's template if this share (in tenths) of its tokens agrees.
SIMILAR_TENTHS = 7
#: Lines that missed their group's template stay together if one in so many lines of the group joined it.
STAY_SHARE = 10
#: A template recurs if so many documents have it.
MIN_DOCS = 3


def _opaque(key: Column) -> Column:
    """A long key the planner takes for a new one, so that both sides of a join are shuffled and skew can be split."""
    return key.bitwiseXOR(F.lit(0).cast("long"))


def masked(line: Column) -> Column:
    """One space between tokens; tokens with a digit are the variable field ``<*>``."""
    odd = line.rlike("[0-9\t\r\f\x0b]|  |^ | $")
    clean = F.trim(F.regexp_replace(line, LINE_SPACE, " "))
    return F.when(odd, F.regexp_replace(clean, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*", "<*>")).otherwise(line)


def _tree_rows(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, pos, leaf, line) of every line that enters the tree.

    Lines are masked inside the array, before they become rows: what follows
    uses the masked line several times and must not work it out again.
    """
    rows = documents.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                            F.posexplode(F.transform(lines_of(F.col(text_col)), masked)).alias("pos", "masked"))
    tokens = F.when(F.col("masked") == "", 0).otherwise(F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1)
    path = F.substring_index("masked", " ", DEPTH)
    return rows.where(tokens > 0).select("id", "text_hash", "pos", F.xxhash64(tokens, path).alias("leaf"),
                                                   F.xxhash64("masked").alias("line"))


def _templates(documents: DataFrame, found: DataFrame, each: DataFrame, min_docs: int, id_col: str, text_col: str) -> DataFrame:
    """``(leaf, line, template)`` of the distinct lines that belong to a template of their leaf.

    Only leaves with several different lines and at least ``min_docs``
    sightings can yield one. In such a leaf each position's most frequent
    token over the different lines (ties: the smallest) is the template's
    token; a line agreeing in enough positions joins it, its other positions
    being variable. Where a tenth of a group joined, the lines that missed are
    a group of their own for the next round; otherwise they are split by the
    tokens of the position that holds the group's most frequent token not
    shared by all, until no two lines share one. So a group shrinks by a tenth
    or gains a fixed position in every round, and rounds grow with the
    logarithm of a leaf's lines and with its tokens, not with its templates.
    The tokens are read again from one document per line.
    """
    wide = (each.groupBy("leaf").agg(F.count("*").alias("lines"), F.sum("docs").alias("docs"))
            .where((F.col("lines") > 1) & (F.col("docs") >= min_docs)).select(_opaque(F.col("leaf")).alias("leaf")))
    place = F.min(F.struct("id", "text_hash", "pos")).alias("place")
    # The lines of a hot leaf are grouped apart from each other, not where the join by leaf put them.
    wanted = (found.join(wide, "leaf", "left_semi").withColumn("leaf", _opaque(F.col("leaf"))).groupBy("leaf", "line")
              .agg(place, F.count("*").alias("sightings")))
    wanted = wanted.groupBy(F.col("place.id").alias("__id"), F.col("place.text_hash").alias("__hash")).agg(
        F.collect_list(F.struct(F.col("place.pos").alias("pos"), "leaf", "line", "sightings")).alias("wanted"))
    text = F.col(text_col)
    lines = (documents.select(F.col(id_col).alias("id"), text.alias("text")).join(
        wanted, F.col("id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash")))
        .select(lines_of(F.col("text")).alias("lines"), "wanted")
        .select(F.explode(F.transform("wanted", lambda w: F.struct(
            w["leaf"].alias("leaf"), w["line"].alias("line"), w["sightings"].alias("sightings"),
            masked(F.get("lines", w["pos"])).alias("masked")))).alias("w")).select("w.*"))
    lines = lines.dropDuplicates(["leaf", "line"])  # rows equal in id and text bring a line twice
    rest = materialise(lines.select("leaf", "line", "sightings", F.col("leaf").alias("group"), F.split("masked", " ").alias("tokens")), "template-lines")
    names, at = None, 0
    while at == 0 or not rest.isEmpty():
        judged = materialise(_judged(rest, min_docs), "template-round")
        joined = judged.where("joins").select("leaf", "line", F.col("group").alias("template"))
        names = joined if names is None else names.unionAll(joined)
        some = judged.groupBy("group").agg((F.count_if("joins") * STAY_SHARE >= F.count("*")).alias("stay")).select(_opaque(F.col("group")).alias("group"), "stay")
        again = F.when(F.col("stay"), F.xxhash64("group", F.lit(at))).otherwise(
            F.xxhash64("group", F.lit(at), "split", F.get("tokens", F.col("split"))))
        rest = materialise(judged.where("not joins").join(some, "group").where(F.col("stay") | F.col("split").isNotNull()).select(
            "leaf", "line", "sightings", again.alias("group"), "tokens"), "template-rest")
        at += 1
    return names


def _judged(rest: DataFrame, min_docs: int) -> DataFrame:
    """``rest`` with ``joins`` (the line agrees with its group's modal tokens) and ``split``, the position to split the group at (null: none).

    Groups of one line, or with too few sightings, are left out.
    """
    counts = (rest.select("group", "sightings", F.posexplode("tokens").alias("at", "token")).groupBy("group", "at", "token")
              .agg(F.count("*").alias("c"), F.sum("sightings").alias("s")))
    places = counts.groupBy("group", "at").agg(F.min(F.struct(-F.col("c"), F.col("token"))).alias("best"),
                                               F.max("c").alias("c"), F.sum("c").alias("lines"), F.sum("s").alias("s"))
    odd = F.when((F.col("c") < F.col("lines")) & (F.col("c") > 1), F.struct(F.col("c"), -F.col("at")))
    modal = (places.groupBy("group").agg(F.sort_array(F.collect_list(F.struct(F.col("at"), F.col("best.token").alias("token")))).alias("modal"),
                                         F.max(odd).alias("odd"), F.max("lines").alias("lines"), F.max("s").alias("s"))
             .where((F.col("lines") > 1) & (F.col("s") >= min_docs))
             .select(_opaque(F.col("group")).alias("group"), F.col("modal.token").alias("modal"), (-F.col("odd.col2")).alias("split")))
    same = F.aggregate(F.zip_with("tokens", "modal", lambda a, b: (a == b).cast("int")), F.lit(0), lambda a, b: a + b)
    return rest.join(modal, "group").select("leaf", "line", "sightings", "group", "tokens", "split",
                                            (same * 10 >= F.size("tokens") * SIMILAR_TENTHS).alias("joins"))


def recurring_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``(id, text_hash, dropped)``: sorted positions of the lines of each document that go.

    A line whose template occurs in at least ``min_docs`` different documents
    goes, except in the document of the smallest id that has it, so the
    corpus keeps one copy of everything. Empty lines stay. Null ids count as
    one document, before all others.
    """
    found = materialise(_tree_rows(documents, id_col, text_col), "lines")
    spread = [F.count("*").alias("docs"), F.when(F.count_if(F.col("id").isNull()) == 0, F.min("id")).alias("first")]
    each = materialise(found.select("leaf", "line", "id").distinct().groupBy("leaf", "line").agg(*spread), "lines-each")
    names = materialise(_templates(documents, found, each, min_docs, id_col, text_col), "templates")
    apart = lambda df: df.withColumnsRenamed({"leaf": "l", "line": "i"}).withColumns({"l": _opaque(F.col("l")), "i": _opaque(F.col("i"))})
    same_line = (F.col("leaf") == F.col("l")) & (F.col("line") == F.col("i"))
    # Lines of a template are judged with it, the others alone; only lines that may go meet the rows again.
    alone = each.where(F.col("docs") >= min_docs).join(apart(names), same_line, "left_anti")
    members = names.select("leaf", "line", "template", F.lit(None).cast(each.schema["first"].dataType).alias("first"))
    likely = apart(members.unionByName(alone.select("leaf", "line", F.lit(None).cast("long").alias("template"), "first")))
    hits = materialise(found.join(likely, same_line).select("id", "text_hash", "pos", "leaf", "template", "first"), "lines-likely")
    whole = (hits.where("template is not null").select("leaf", "template", "id").distinct().groupBy("leaf", "template").agg(*spread)
             .where(F.col("docs") >= min_docs).select(_opaque(F.col("leaf")).alias("leaf"), _opaque(F.col("template")).alias("template"), "first"))
    gone = hits.where("template is null").select("id", "text_hash", "pos", "first").union(
        hits.drop("first").join(whole, ["leaf", "template"]).select("id", "text_hash", "pos", "first")).where(~F.col("id").eqNullSafe(F.col("first")))
    return gone.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def drop_recurring(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``documents`` with recurring lines taken out of the text, and ``n_lines`` and ``n_dropped``.

    Null texts stay null (0 lines); rows equal in id and text are handled
    alike. Columns of those two names are replaced; an empty table stays
    empty.
    """
    gone = recurring_lines(documents, id_col, text_col, min_docs).withColumnsRenamed({"id": "__id", "text_hash": "__hash", "dropped": "__dropped"})
    names = [c for c in documents.columns if c not in ("n_lines", "n_dropped")]
    text, dropped = F.col(text_col), F.col("__dropped")
    joined = documents.select(*names).join(gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left")
    return joined.select(*[without_lines(text, dropped).alias(c) if c == text_col else F.col(c) for c in names],
                         F.coalesce(F.size(lines_of(text)), F.lit(0)).alias("n_lines"),
                         F.greatest(F.coalesce(F.size(dropped), F.lit(0)), F.lit(0)).alias("n_dropped"))


def op2_line_dedup(documents: DataFrame) -> DataFrame:
    return drop_recurring(documents).select("doc_id", "n_lines", "n_dropped", "text")
