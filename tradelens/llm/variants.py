"""Spelling variants: words one edit apart, found along a trie by joins.

The trie is relational. A node is a hash of the letters read so far, an edge leads over one or more
letters to the next node where words part or end, and both are distributed tables. A state is
(word, position, node, edits); every round joins all states with the edges of their nodes and keeps
those that agree with the edge, or differ from it by the one edit they still have. States that
arrive at a word's end with one edit have found a neighbour, whose letters are then compared.

An edit need only be made where the two words part. If that is in the second half, the first half is
shared, so states start at their own word's first node there; otherwise the second half is shared,
and the same holds in the trie of the words read backwards. Of two neighbours only one searches: the
longer one by a deletion, or the one with the smaller letter by a replacement. A node knows the
lengths and the next letters that are below it, so that most states that lead nowhere are not kept.

Two letters' range bounds a node's edges (90 letters), so a node that very many words share has few
rows on the edges' side, and its states can be split by the adaptive skew join.

Defined cases: a null text has no words. A null doc_id spoils no word. Every row counts, also exact
repeats. A word of L letters costs about L^2 bytes of hashing. Words without neighbours have n_near 0.
No words, or an empty table, give an empty result. Columns other than doc_id and text are not
looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.session import materialise

SHORTEST, RAREST, RATIO = 7, 2, 10
DROP_ONE_IN = 31
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_BITS = 62


def words(docs: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """word, n: runs of letters in lower case, one letter dropped where the hash says so."""
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    found = docs.select("doc_id", F.explode(runs).alias("run")) \
        .select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DROP_ONE_IN == 0, shorter).otherwise(F.col("run"))
    return (found.withColumn("h", hashed).select(word.alias("word"))
            .where(F.length("word") >= shortest)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= rarest))


def _node(side: Column, read: Column) -> Column:
    return F.xxhash64(side, read)


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number.cast("int"))


def _has(mask: Column, number: Column) -> Column:
    return F.call_function("shiftright", mask, number.cast("int")).bitwiseAND(F.lit(1)) == 1


def _height(left: Column) -> Column:
    return F.least(left, F.lit(MOST_BITS))


def _letter(text: Column, at: Column) -> Column:
    return F.ascii(F.substring(text, at, F.lit(1))) % MOST_BITS


def sides(words_: DataFrame) -> DataFrame:
    """w, side, s: every numbered word forwards (side 0) and backwards (side 1)."""
    both = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("s")),
                             F.struct(F.lit(1).alias("side"), F.reverse("word").alias("s"))))
    return words_.select("w", both.alias("b")).select("w", "b.side", "b.s")


def _half(side: Column, size: Column) -> Column:
    """Letters shared before an edit on this side: the two sides' add up to the word."""
    return F.when(side == 0, F.floor(size / 2)).otherwise(size - F.floor(size / 2)).cast("int")


def trie(turned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges, and each word's first node in its second half; both written.

    edges: parent, child, label, and of the child: ends (a word does), heights (lengths below it),
    nexts (letters that follow). starts: w, s, pos, node, ends.
    """
    size = F.length("s")
    read = turned.withColumn("at", F.explode(F.sequence(_half(F.col("side"), size), size))) \
        .select("w", "side", "at", _node(F.col("side"), F.substring("s", F.lit(1), F.col("at"))).alias("node"),
                (size - F.col("at")).alias("rest"), F.substring("s", F.col("at") + 1, F.lit(1)).alias("next"),
                _letter(F.col("s"), F.col("at") + 1).alias("bit"))
    follows = F.col("rest") > 0
    nodes = read.groupBy("node").agg(
        F.min("next").alias("lo"), F.max("next").alias("hi"), (F.min("rest") == 0).alias("ends"),
        F.bit_or(_bit(_height(F.col("rest")))).alias("heights"),
        F.coalesce(F.bit_or(F.when(follows, _bit(F.col("bit")))), F.lit(0)).alias("nexts"))
    # A node where all words go on with one letter is no node; lo is empty where a word ends.
    nodes = materialise(nodes.where("lo <> hi OR ends").drop("lo", "hi"))
    path = read.select("w", "side", "at", "node").join(nodes.select("node", "ends"), "node")
    along = Window.partitionBy("w", "side").orderBy("at")
    path = path.withColumns({"child": F.lead("node").over(along), "to": F.lead("at").over(along),
                             "first": F.row_number().over(along) == 1})
    path = materialise(path.join(turned, ["w", "side"]).select(
        "w", "s", F.col("at").alias("pos"), "node", "ends", "first", "child",
        F.substring("s", F.col("at") + 1, F.col("to") - F.col("at")).alias("label")))
    edges = path.where("child IS NOT NULL").select(F.col("node").alias("parent"), "child", "label") \
        .distinct().join(nodes.withColumnRenamed("node", "child"), "child")
    return materialise(edges), path.where("first").select("w", "s", "pos", "node", "ends")


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one edge further on."""
    s, pos, label = F.col("s"), F.col("pos"), F.col("label")
    size = F.length(label)
    here, head = F.substring(s, pos + 1, F.lit(1)), F.substring(label, F.lit(1), F.lit(1))
    free = (F.col("edits") == 0) & (here != head)
    exact = F.substring(s, pos + 1, size) == label
    replaced = free & (head > here) & \
        (F.substring(s, pos + 2, size - 1) == F.substring(label, F.lit(2), size - 1))
    dropped = free & (F.substring(s, pos + 2, size) == label)

    def lives(to: Column) -> Column:
        """The child has a word of the letters that are left, as far as its masks tell."""
        left = F.length(s) - to
        return F.when(left == 0, F.col("child_ends")).otherwise(
            _has(F.col("heights"), _height(left)) & _has(F.col("nexts"), _letter(s, to + 1)))

    own = exact & (F.col("edits") == 0) & (pos + size < F.length(s))
    on = exact & (F.col("edits") == 1) & lives(pos + size)
    replaced, dropped = replaced & lives(pos + size), dropped & lives(pos + size + 1)
    joined = states.join(edges.withColumnRenamed("ends", "child_ends"), F.col("node") == F.col("parent")) \
        .where(own | on | replaced | dropped)

    def to(condition: Column, position: Column, edits: int) -> Column:
        return F.when(condition, F.struct(position.alias("pos"), F.lit(edits).alias("edits")))
    ways = F.array(to(own, pos + size, 0), to(on | replaced, pos + size, 1),
                   to(dropped, pos + size + 1, 1))
    return joined.select("w", "s", "child", "child_ends", F.explode(F.array_compact(ways)).alias("x")) \
        .select("w", "s", "x.pos", F.col("child").alias("node"), F.col("child_ends").alias("ends"), "x.edits")


def near_words(words_: DataFrame) -> DataFrame:
    """a, b: numbers of words that differ by one inserted, deleted or replaced letter, both ways round.

    ``words_`` has w (a number of its own for each word), word. The frontier of every level is written.
    """
    turned = sides(words_)
    edges, starts = trie(turned)
    frontier = starts.withColumn("edits", F.lit(0))
    found = []
    while True:
        frontier = materialise(frontier)
        last = F.length("s") - F.lit(1) + F.col("edits")
        found.append(frontier.where(F.col("ends") & (F.col("pos") == last)).select("w", "node"))
        going = frontier.where(F.col("pos") < F.length("s"))
        if going.isEmpty():
            break
        frontier = _step(going, edges)
    ends = turned.select(F.col("w").alias("b"), _node(F.col("side"), F.col("s")).alias("node"))
    pairs = reduce(DataFrame.unionByName, found).join(ends, "node") \
        .select(F.least("w", "b").alias("a"), F.greatest("w", "b").alias("b")).distinct()
    spelt = pairs.join(words_.select(F.col("w").alias("a"), F.col("word").alias("x")), "a") \
        .join(words_.select(F.col("w").alias("b"), F.col("word").alias("y")), "b")
    one = materialise(spelt.where(F.levenshtein("x", "y", 1) == 1).select("a", "b"))
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b")))


def roots(forms: DataFrame) -> DataFrame:
    """w, root: the last of w, form of w, form of that ... for every w that has a form.

    The counts of forms grow by ``RATIO`` each time, so chains are short; they are halved each round.
    """
    links = materialise(forms.select("w", F.col("form_w").alias("root")))
    while True:
        next_ = links.select(F.col("w").alias("root"), F.col("root").alias("further"))
        moved = materialise(links.join(next_, "root", "left").select(
            "w", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        links = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return links


def variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the documents.

    form: the neighbour with the largest n (ties: the smallest word) if that is ``ratio`` times the
    word's n or more; root: the end of the chain of forms.
    """
    counted = words(docs).withColumn("w", F.monotonically_increasing_id())
    counted = materialise(counted)
    other = counted.select(F.col("w").alias("b"), F.col("word").alias("y"), F.col("n").alias("m"))
    best = near_words(counted).join(other, "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("m")).alias("minus"), F.col("y").alias("form"),
                       F.col("b").alias("form_w"))).alias("best"))
    known = counted.join(best.withColumnRenamed("a", "w"), "w", "left")
    strong = -F.col("best.minus") >= F.col("n") * ratio
    known = materialise(known.select(
        "w", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("best.form")).alias("form"), F.when(strong, F.col("best.form_w")).alias("form_w"),
        F.when(strong, -F.col("best.minus")).alias("form_n")))
    last = roots(known.where("form_w IS NOT NULL")) \
        .join(counted.select(F.col("w").alias("root"), F.col("word").alias("root_word")), "root") \
        .select("w", "root_word")
    return known.join(last, "w", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
