"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.frames import stored

# A piece is at most this many code points of a paragraph; digests in the string keep this many hex digits.
PIECE = 64
DIGITS = 10


def fingerprint(text: Column) -> Column:
    """``root:section|section`` with a section as ``digest;paragraph,paragraph`` and a paragraph as ``piece.piece``.

    Sections are parted by blank lines, paragraphs by line ends, pieces by length from the start of the paragraph.
    A paragraph's digest covers the digests of its pieces, a section's those of its paragraphs, the root those of
    the sections, so equal roots mean equal texts and unequal branches lead to the edits. Null counts as empty.
    """
    piece_digests = lambda p: F.transform(F.regexp_extract_all(p, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), F.md5)
    sections = F.split(F.coalesce(text, F.lit("")), "\n\n", -1)
    tree = F.transform(sections, lambda s: F.transform(F.split(s, "\n", -1), piece_digests))
    section_digest = lambda s: F.md5(F.array_join(F.transform(s, lambda p: F.md5(F.array_join(p, ""))), ""))
    cut = lambda p: F.array_join(F.transform(p, lambda d: F.substring(d, 1, DIGITS)), ".")
    with_digests = F.transform(
        tree,
        lambda s: F.struct(
            section_digest(s).alias("digest"), F.array_join(F.transform(s, cut), ",").alias("paragraphs")
        ),
    )
    # One walk over the tree: the digests go into the root, the strings behind it.
    return F.transform(
        F.array(with_digests),
        lambda t: F.concat(
            F.md5(F.array_join(F.transform(t, lambda s: s["digest"]), "")),
            F.lit(":"),
            F.array_join(
                F.transform(t, lambda s: F.concat(F.substring(s["digest"], 1, DIGITS), F.lit(";"), s["paragraphs"])), "|"
            ),
        ),
    )[0]


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def leaves(print_: Column) -> Column:
    """The distinct piece digests of a fingerprint."""
    body = F.regexp_replace(F.substring_index(print_, ":", -1), f"[0-9a-f]{{{DIGITS}}};", "")
    return F.array_remove(F.array_distinct(F.split(body, "[.,|]")), "")


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """1 for equal roots, else twice the shared pieces over the pieces of both (0 without any)."""
    shared = 2.0 * F.size(F.array_intersect(leaves_a, leaves_b))
    return F.when(root_a == root_b, F.lit(1.0)).otherwise(shared / F.greatest(F.size(leaves_a) + F.size(leaves_b), F.lit(1)))


def differing_branches(a: Column, b: Column) -> Column:
    """Numbers (``section``, ``paragraph``) of the branches in which two fingerprints differ, both from 0.

    Sections with equal digests are not entered. Where one text has more branches, the further ones differ.
    """
    sections = lambda p: F.split(F.substring_index(p, ":", -1), "\\|", -1)
    pairs = F.transform(
        F.arrays_zip(sections(a).alias("x"), sections(b).alias("y")),
        lambda s, i: F.struct(i.alias("i"), s["x"].alias("x"), s["y"].alias("y")),
    )
    changed = F.filter(pairs, lambda s: ~s["x"].eqNullSafe(s["y"]))
    paragraphs = lambda s: F.split(F.substring_index(F.coalesce(s, F.lit("")), ";", -1), ",", -1)

    def within(s: Column) -> Column:
        both = F.arrays_zip(paragraphs(s["x"]).alias("x"), paragraphs(s["y"]).alias("y"))
        numbered = F.transform(both, lambda p, j: F.struct(j.alias("j"), p["x"].alias("x"), p["y"].alias("y")))
        unequal = F.filter(numbered, lambda p: ~p["x"].eqNullSafe(p["y"]))
        return F.transform(unequal, lambda p: F.struct(s["i"].alias("section"), p["j"].alias("paragraph")))

    return F.flatten(F.transform(changed, within))


def following_ids(ids: DataFrame) -> DataFrame:
    """``doc_id`` and ``next_id``, the next smaller distinct id (of the smallest: the largest), without nulls.

    Ids are sorted in ranges; only the first id of each range meets those of the others, one row per partition.
    """
    ordered = ids.select("doc_id").where("doc_id IS NOT NULL").distinct()
    ordered = ordered.repartitionByRange(F.col("doc_id").desc()).withColumn("part", F.spark_partition_id())
    ordered = stored(ordered, "ids")
    tops = ordered.groupBy("part").agg(F.max("doc_id").alias("top"))
    after = F.lead("top").over(Window.orderBy("part"))
    tops = tops.withColumn("after", after).select("part", "after")
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.col("doc_id").desc()))
    rows = ordered.withColumn("inside", inside).join(tops, "part")
    first = ordered.agg(F.max("doc_id")).first()[0]
    return rows.select("doc_id", F.coalesce("inside", "after", F.lit(first)).alias("next_id"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of its edited text and its likeness to that and to the next document.

    The edited text has its last floor(n / 3) code points replaced by the first as many of the next document in
    descending order of ids. Where an id is repeated, each row is fingerprinted, and the row with the smallest
    prefix serves as the next document. A row without an id has no next document: an empty text takes its place.
    """
    # Without a needless alias both uses of the table below stay equal plans, whose exchange Spark shares.
    ids = F.col(id_col) if id_col == "doc_id" else F.col(id_col).alias("doc_id")
    rows = docs.select(ids, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = rows.where("doc_id IS NOT NULL")
    third = F.floor(F.char_length("text") / 3).cast("int")
    wanted = known.groupBy("doc_id").agg(F.max(third).alias("k")).join(following_ids(known), "doc_id")
    wanted = stored(wanted.select(F.col("doc_id").alias("for_id"), "k", "next_id"), "wanted")
    # Both joins deal the same table by id, so that Spark moves the texts once.
    sent = known.join(wanted, known["doc_id"] == wanted["next_id"]).select(
        "for_id", F.expr("left(text, k)").alias("prefix"), fingerprint(F.col("text")).alias("print")
    )
    sent = sent.groupBy("for_id").agg(F.min(F.struct("prefix", "print")).alias("next"))
    paired = known.join(sent, known["doc_id"] == sent["for_id"]).select("doc_id", "text", "next")
    alone = rows.where("doc_id IS NULL").select(
        "doc_id", "text", F.struct(F.lit("").alias("prefix"), fingerprint(F.lit("")).alias("print")).alias("next")
    )
    n = F.char_length("text")
    both = paired.unionAll(alone).select(
        "doc_id", n.cast("long").alias("n_chars"), "text", "next",
        F.concat(F.expr("left(text, char_length(text) - CAST(floor(char_length(text) / 3) AS INT))"),
                 F.expr("left(next.prefix, CAST(floor(char_length(text) / 3) AS INT))")).alias("edited"),
    )
    prints = both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"), F.col("next.print").alias("next_print"),
    )
    parts = {"a": "fingerprint", "b": "edited_fingerprint", "c": "next_print"}
    sets = prints.select(
        "*", *[root(F.col(c)).alias(f"root_{k}") for k, c in parts.items()],
        *[leaves(F.col(c)).alias(f"leaves_{k}") for k, c in parts.items()],
    )
    like = lambda k: likeness(F.col("root_a"), F.col("leaves_a"), F.col(f"root_{k}"), F.col(f"leaves_{k}"))
    return sets.select(
        F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        like("b").alias("near_edited"), like("c").alias("near_next"),
    )


def _print_sql(text: str) -> str:
    pieces = f"list_transform(regexp_extract_all(p, '(?s).{{1,{PIECE}}}'), lambda w: md5(w))"
    tree = f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: {pieces}))"
    digest = "md5(list_aggregate(list_transform(s, lambda p: md5(coalesce(list_aggregate(p, 'string_agg', ''), ''))), 'string_agg', ''))"
    cut = f"coalesce(list_aggregate(list_transform(p, lambda d: substr(d, 1, {DIGITS})), 'string_agg', '.'), '')"
    return f"""(SELECT md5(list_aggregate(list_transform(t, lambda s: {digest}), 'string_agg', '')) || ':' || list_aggregate(
      list_transform(t, lambda s: substr({digest}, 1, {DIGITS}) || ';' || list_aggregate(list_transform(s, lambda p: {cut}), 'string_agg', ',')), 'string_agg', '|')
      FROM (SELECT {tree} AS t))"""


SQL = f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next
  FROM documents WINDOW w AS (ORDER BY doc_id DESC)
), edited AS (
  SELECT *, length(text) AS n, substr(text, 1, length(text) - length(text) // 3) || substr(next, 1, length(text) // 3) AS edited
  FROM ordered
), prints AS (
  SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, {_print_sql("text")} AS fingerprint,
    {_print_sql("edited")} AS edited_fingerprint, {_print_sql("next")} AS next_print FROM edited
), sets AS (
  SELECT *, {", ".join(f"list_filter(list_distinct(regexp_split_to_array(regexp_replace(split_part({c}, ':', 2), '[0-9a-f]{{{DIGITS}}};', '', 'g'), '[.,|]')), lambda x: x <> '') AS l{k}" for k, c in (("a", "fingerprint"), ("b", "edited_fingerprint"), ("c", "next_print")))}
  FROM prints
)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN split_part(fingerprint, ':', 1) = split_part(edited_fingerprint, ':', 1) THEN 1.0::DOUBLE
    ELSE 2.0::DOUBLE * len(list_intersect(la, lb)) / greatest(len(la) + len(lb), 1) END AS near_edited,
  CASE WHEN split_part(fingerprint, ':', 1) = split_part(next_print, ':', 1) THEN 1.0::DOUBLE
    ELSE 2.0::DOUBLE * len(list_intersect(la, lc)) / greatest(len(la) + len(lc), 1) END AS near_next
FROM sets
"""
