"""Line dedup by winnowing: least line hashes of windows find shared runs of lines, and later runs are deleted.

DataFrame operations only. Windows are measured in words: from every line on, the fewest
lines that hold ``least_words``. The position of each window's least line hash is kept
once as a fingerprint. Two runs of equal lines with that many words hold a window each
with the same lines, and so the same fingerprint: every shared run is found, whatever
surrounds it. Fingerprints that stand at several positions are joined, and the match is
extended both ways: from the lines of a window with such a fingerprint, forwards and
backwards, every window that equals an earlier one line by line is part of a repeat.

A fingerprint is not compared with its first occurrence alone, as a plainer form would:
its line may first stand in other surroundings, and the run that two later documents
share around it would be lost. Windows are compared by their whole content instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import col, free_name, n_words, store

BREAK = r"\n"
LINE_SPACE = " \t\r\x0b\x0c"


def line_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, position, seq, hash, check, words, before) of every line with a word, once for each distinct document.

    ``doc`` is the key with a digest of the text; ``seq`` counts lines with words and
    ``before`` the words in them before this line.
    """
    slim = docs.select(F.struct(col(key).alias("key"), F.xxhash64(col(text)).alias("digest")).alias("doc"), col(text).alias("text"))
    lines = slim.select("doc", F.posexplode(F.split("text", BREAK)).alias("position", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(LINE_SPACE))).select(
        "doc", "position", F.xxhash64("line").alias("hash"), F.xxhash64(F.lit(1), F.col("line")).alias("check"), n_words(F.col("line")).alias("words")
    )
    lines = lines.filter("words > 0").repartition("doc").dropDuplicates(["doc", "position"])
    order = Window.partitionBy("doc").orderBy("position")
    return lines.withColumns(
        {"seq": F.row_number().over(order), "before": F.sum("words").over(order) - F.col("words")}
    )


def forward_windows(lines: DataFrame, least_words: int) -> DataFrame:
    """``lines`` with the window that each begins: its ``last`` line, ``fingerprint`` and content, if it is long ``enough``.

    The least hash's position never goes back from one window to the next, so ``picked``
    marks the first window of each: its fingerprint is a new one.
    """
    by_start = Window.partitionBy("doc").orderBy("before")
    # Lines after this one belong to the window while the words before them, counted from here, are too few.
    ahead = by_start.rangeBetween(0, least_words - 1)
    least = F.min(F.struct("hash", (-F.col("seq")).alias("at"))).over(ahead)  # the last of equal hashes
    found = lines.withColumns(
        {
            "least": least,
            "last": F.max("seq").over(ahead),
            "enough": F.sum("words").over(ahead) >= least_words,
            "content": F.xxhash64(F.collect_list("hash").over(ahead)),
            "content_check": F.xxhash64(F.collect_list("check").over(ahead)),
        }
    )
    fresh = F.coalesce(F.lag("least.at").over(by_start) != F.col("least.at"), F.lit(True))
    return found.withColumn("picked", fresh & F.col("enough")).select(
        *lines.columns, "last", F.col("least.hash").alias("fingerprint"), "picked", "enough", "content", "content_check"
    )


def backward_windows(lines: DataFrame, least_words: int) -> DataFrame:
    """(doc, first, last, fingerprint, content, content_check) of every window of several lines that ends at a line.

    Its fingerprint is that of the forward window at its first line, which lies in it.
    """
    behind = Window.partitionBy("doc").orderBy(F.col("before") + F.col("words")).rangeBetween(-(least_words - 1), 0)
    # A line that is long enough alone is no window of several; those before it do not count for it.
    found = lines.select(
        "doc",
        F.min("seq").over(behind).alias("first"),
        F.col("seq").alias("last"),
        F.first("fingerprint").over(behind).alias("fingerprint"),
        F.xxhash64(F.collect_list("hash").over(behind)).alias("content"),
        F.xxhash64(F.collect_list("check").over(behind)).alias("content_check"),
        (F.sum("words").over(behind) >= least_words).alias("enough"),
    )
    return found.filter("enough AND first < last").drop("enough")


def repeats(lines: DataFrame, back: DataFrame) -> DataFrame:
    """Windows that were seen before, with the document and line where they were seen first.

    Only windows whose fingerprint stands at several positions can be; counting positions
    is combined on the map side. Of those each is compared with the first window of equal
    content, found by a map-side combined minimum, so a line that stands in every document
    makes one row a window and no pairs.
    """
    shared = lines.filter("picked").groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select("fingerprint")
    ahead = lines.filter("enough").select(F.lit(0).alias("way"), "doc", F.col("seq").alias("first"), "last", "fingerprint", "content", "content_check")
    found = ahead.unionByName(back.withColumn("way", F.lit(1))).join(shared, "fingerprint", "left_semi")
    same = ["way", "fingerprint", "content", "content_check"]
    # Null keys come last, so that documents with a key hold the first occurrence.
    at = F.struct(F.col("doc.key").isNull().alias("none"), "doc", "first")
    firsts = found.withColumn("at", at).groupBy(*same).agg(F.min("at").alias("origin"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return found.join(firsts, same).filter(at != F.col("origin")).select("way", "doc", "first", "last", "origin")


def repeated_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least_words: int = 20) -> DataFrame:
    """(doc, positions): the lines of every document to be deleted, by their sorted positions from 0.

    Windows reach forwards from a run's first lines and backwards from its last, so the
    union of those that repeat is the whole run: a match goes both ways as far as lines agree.
    """
    lines = store(forward_windows(line_rows(docs, key, text), least_words), "lines")
    back = store(backward_windows(lines, least_words), "windows")
    runs = repeats(lines, back).select("doc", "first", "last").distinct()
    covered = runs.select("doc", F.explode(F.sequence("first", "last")).alias("seq")).distinct()
    hit = lines.join(covered, ["doc", "seq"], "left_semi")
    return hit.groupBy("doc").agg(F.sort_array(F.collect_list("position")).alias("positions"))


def mask(positions: Column) -> Column:
    """Sorted positions as bytes: 1 where a line goes, 0 before and between. A byte is found at once by its place."""
    gap = lambda p, i: F.repeat(F.lit("0"), p - F.when(i > 0, F.get(positions, i - 1)).otherwise(-1) - 1)
    return F.array_join(F.transform(positions, lambda p, i: F.concat(gap(p, i), F.lit("1"))), "").cast("binary")


def drop_repeated_lines(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", least_words: int = 20, lines: str = "n_lines", deleted: str = "n_deleted"
) -> DataFrame:
    """``docs`` with repeated runs of lines cut out of ``text``, the number of its lines and of those deleted.

    A line goes if it lies in a run of consecutive lines with ``least_words`` words or more
    that already stands earlier: in a document with a smaller key, or further up in the
    same one. Lines compare by their text without white space around it; lines without a
    word are skipped over and stay. Passages below ``least_words`` stay, and so does the part
    of a passage that shares a line with other text, since lines are compared as a whole.
    Equal keys are told apart by a digest of the text, and
    rows equal in both are one document, each with the same result. Null keys come last. A
    null text stays null with no lines, an empty text has one. Texts of any number of lines
    and lines of any length are read as a whole; one document's lines are sorted in one
    task. Columns that have the result names already are replaced. An empty table gives no rows.
    """
    docs = docs.drop(lines, deleted)
    gone = repeated_lines(docs, key=key, text=text, least_words=least_words)
    marked, mine = free_name(docs, "mask"), free_name(docs, "line_doc")
    gone = store(gone.select(F.col("doc").alias("gone_doc"), mask(F.col("positions")).alias(marked)), "gone")
    digest = F.struct(col(key).alias("key"), F.xxhash64(col(text)).alias("digest"))
    # A merge join at every size: the documents are shuffled once, and no size makes another plan of it.
    held = docs.withColumn(mine, digest).join(gone.hint("merge"), F.col(mine).eqNullSafe(F.col("gone_doc")), "left")
    whole = F.split(col(text), BREAK)
    one = F.lit("1").cast("binary")
    rest = F.filter(whole, lambda line, i: F.substring(F.col(marked), i + 1, F.lit(1)) != one)
    kept = F.when(F.col(marked).isNull(), col(text)).otherwise(F.array_join(rest, "\n"))
    n_gone = F.coalesce(F.length(F.regexp_replace(F.col(marked).cast("string"), "0", "")), F.lit(0))
    n_lines = F.when(col(text).isNull(), 0).otherwise(F.size(whole))
    columns = [kept.alias(c) if c == text else col(c) for c in docs.columns]
    return held.select(*columns, n_lines.cast("long").alias(lines), n_gone.cast("long").alias(deleted))
