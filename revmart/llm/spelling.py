"""Spelling variants by a dictionary of trie-node pairs.

The distinct words, sorted, are walked once in range partitions, and every
node of their trie (a distinct prefix) gets an integer; the reversed words
give the nodes of the distinct suffixes in the same way. A word then has one
integer pair for each place: (prefix node, suffix node) with the character
between them skipped, or with nothing skipped, as if one were inserted.
Two words that share a skipped pair differ by one replaced character; a
word's skipped pair that is another's inserted pair makes the latter the
former without that character. Equal nodes mean equal prefixes and suffixes,
so neighbours are exact and strings are never compared again.

A pair has one word at most that it spells without a skip, and its other
words differ in a single character, so a pair has no more rows than there
are letters. Its rows meet by a window that gives each the number of its
partners and the best of them; pairs of words are never written out.

Nodes near the root belong to several range partitions. Those are prefixes
of a partition's first word and of the last word before it: two words a
partition go to the driver, which names each such node once.

Defined results: null and empty texts have no words; words may be of any
length; repeated rows count each; an empty table gives no rows; other
columns are not read; a null doc_id counts as an empty one. Equal counts go
to the first word in code-point order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from revmart.llm.common import ascii_lower, materialise

#: Fixed value: what words are made of.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Bits of a number that count within a partition.
_LOCAL = 40


def letter_runs(docs: DataFrame, every: int = 199) -> DataFrame:
    """One row per run of letters of ``documents``: word, A-Z in lower case.

    A run whose hash with its document ``every`` divides loses one letter.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                       F.explode(F.regexp_extract_all(ascii_lower("text"), F.lit(f"({LETTERS})"))).alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    gone = (F.col("h") % F.char_length("run")).cast("int")
    return runs.select("run", h.alias("h")).select(
        F.when(F.col("h") % every == 0, F.concat(F.substring("run", F.lit(1), gone),
                                                 F.substring("run", gone + 2, F.char_length("run"))))
        .otherwise(F.col("run")).alias("word"))


def frequent_words(words: DataFrame, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """word, n of the words of at least ``min_length`` code points that occur ``min_count`` times."""
    return (words.filter(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def number_nodes(df: DataFrame, key: str, name: str) -> DataFrame:
    """The rows in order of the distinct strings ``key``, with the trie nodes of each.

    Adds ``part`` and ``seq`` (which rises with the key) and the array
    ``name``: the node of the prefix of length 0, 1, ... (the root is 0). Each
    partition counts for itself, see ``shared_nodes``.
    """
    schema = StructType([*df.schema.fields]).add("part", IntegerType()).add("seq", LongType()).add(
        name, ArrayType(LongType()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, path, node, seq = "", [0], part << _LOCAL, part << _LOCAL
        for batch in batches:
            ends, nodes = [0], []
            for word in batch.column(key).to_pylist():
                known = len(commonprefix((before, word)))
                new = len(word) - known
                path = path[:known + 1] + list(range(node + 1, node + new + 1))
                node += new
                before = word
                nodes += path
                ends.append(len(nodes))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(nodes, pa.int64()))], schema.names)
            seq += n

    return df.repartitionByRange(key).sortWithinPartitions(key).mapInArrow(walk, schema)


def shared_nodes(numbered: DataFrame, key: str, name: str) -> DataFrame:
    """(node, same): numbers that a partition gave to nodes which an earlier one had numbered.

    At most as many rows as the longest word has letters, per partition.
    """
    edge = F.struct("seq", key, name)
    ends = numbered.groupBy("part").agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
    same: dict[int, int] = {}
    before, path = "", [0]
    for row in sorted(ends.collect(), key=lambda r: r["part"]):  # two words a partition
        for depth in range(1, len(commonprefix((before, row["first"][key]))) + 1):
            same[row["first"][name][depth]] = path[depth]
        before, path = row["last"][key], [same.get(x, x) for x in row["last"][name]]
    return numbered.sparkSession.createDataFrame(list(same.items()), "node long, same long")


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (word, n): the numbered words (id, word, n), and their pairs.

    A pair's row: p, s, skips (a character between them is skipped), first
    (that character is not the one before it), id, n.
    """
    forward = materialise(number_nodes(words.select("word", "n"), "word", "prefixes"), "trie-forward")
    backward = materialise(number_nodes(
        forward.select(F.col("seq").alias("id"), "word", "n", "prefixes", F.reverse("word").alias("back")),
        "back", "suffixes"), "trie-backward")
    size = F.size("prefixes")  # one more than the word has characters
    letters = F.split("word", "")

    def places(p, i):
        skipped = F.struct(p.alias("p"), F.get("suffixes", size - i - 2).alias("s"), F.lit(True).alias("skips"),
                           ((i == 0) | (F.get("letters", i) != F.get("letters", i - 1))).alias("first"))
        inserted = F.struct(p.alias("p"), F.get("suffixes", size - i - 1).alias("s"), F.lit(False).alias("skips"),
                            F.lit(False).alias("first"))
        return F.when(i == size - 1, F.array(inserted)).otherwise(F.array(skipped, inserted))

    rows = (backward.select("id", "n", "prefixes", "suffixes", letters.alias("letters"))
            .select("id", "n", F.inline(F.flatten(F.transform("prefixes", places)))))
    for side, numbered, key, name in (("p", forward, "word", "prefixes"), ("s", backward, "back", "suffixes")):
        same = shared_nodes(numbered, key, name)
        rows = (rows.join(F.broadcast(same), F.col(side) == F.col("node"), "left")
                .withColumn(side, F.coalesce("same", side)).drop("node", "same"))
    return forward.select(F.col("seq").alias("id"), "word", "n"), rows


def neighbours(pairs: DataFrame) -> DataFrame:
    """Per word that has any: id, n_near, and its near word of largest n, as best (n, minus its id)."""
    pair = Window.partitionBy("p", "s")
    ranked = pair.orderBy(F.col("skips").desc(), F.col("n").desc(), "id")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct("n", (-F.col("id")).alias("minus"))
    skipped = F.when(F.col("skips"), me)
    met = pairs.select(
        "id", "n", "skips", "first",
        F.count_if("skips").over(whole).alias("n_skips"),
        F.count_if("first").over(whole).alias("n_first"),
        F.row_number().over(ranked).alias("rank"),
        F.nth_value(skipped, 1).over(whole).alias("one"),
        F.nth_value(skipped, 2).over(whole).alias("two"),
        F.max(F.when(F.col("first"), me)).over(whole).alias("longer"),
        F.max(F.when(~F.col("skips"), me)).over(whole).alias("shorter"))
    other = F.when(F.col("rank") == 1, F.col("two")).otherwise(F.col("one"))
    shorter = F.when(F.col("first"), F.col("shorter"))
    # max() over the rows of a word passes over nulls, as greatest() does here.
    near = met.select(
        "id",
        F.when(F.col("skips"), F.col("n_skips") - 1 + shorter.isNotNull().cast("long"))
        .otherwise(F.col("n_first")).alias("n_near"),
        F.when(F.col("skips"), F.greatest(other, shorter)).otherwise(F.col("longer")).alias("best"))
    return (near.filter(F.col("n_near") > 0).groupBy("id")
            .agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best")))


def last_forms(forms: DataFrame, most: int, factor: int) -> DataFrame:
    """From (id, form): id, root, the end of the chain of forms.

    Each form occurs ``factor`` times as often as its word, which bounds a
    chain's length by the largest count ``most``; every round doubles the
    steps taken.
    """
    roots = materialise(forms.select("id", F.col("form").alias("root")), "roots-0")
    steps = max(1, math.ceil(math.log(max(most, 2), factor)))
    for k in range(math.ceil(math.log2(steps))):
        further = roots.select(F.col("id").alias("at"), F.col("root").alias("to"))
        roots = materialise(roots.join(further, F.col("root") == F.col("at"), "left")
                            .select("id", F.coalesce("to", "root").alias("root")), f"roots-{k + 1}")
    return roots


def spelling_variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """From distinct (word, n): word, form, root, n, n_near, form_n.

    A word's form is its near word of largest n, if that is at least
    ``factor`` times its own; root is the last form of the chain.
    """
    numbered, pairs = node_pairs(words)
    near = materialise(neighbours(pairs), "near-words")
    rows = materialise(numbered.join(near.withColumnRenamed("id", "near_id"), F.col("id") == F.col("near_id"), "left")
                       .select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(F.col("best.n") >= factor * F.col("n"), -F.col("best.minus")).alias("form")),
                       "word-forms")
    most = rows.agg(F.max("n")).first()[0] or 0
    chains = last_forms(rows.filter("form is not null").select("id", "form"), most, factor)
    named = rows.filter("form is not null").join(chains.withColumnRenamed("id", "chain_id"), F.col("id") == F.col("chain_id"))
    names = numbered.select(F.col("id").alias("of"), F.col("word").alias("name"), F.col("n").alias("count"))
    named = (named.join(names, F.col("form") == F.col("of")).drop("of", "form")
             .withColumnsRenamed({"name": "form", "count": "form_n"})
             .join(names, F.col("root") == F.col("of")).drop("of", "root", "count").withColumnRenamed("name", "root"))
    alone = rows.filter("form is null").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"),
                                               "n", "n_near", F.lit(None).cast("long").alias("form_n"))
    return named.select("word", "form", "root", "n", "n_near", "form_n").unionByName(alone)


#: The same rows by strings: words meet by their text with one letter left out. CRC-32 is spelled out, byte by byte.
VARIANTS_SQL = """
WITH RECURSIVE bits AS (
  SELECT i, i AS r, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(r ORDER BY i) AS t FROM bits WHERE k = 8
), runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                                 '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 6
  GROUP BY doc_id, run
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
           CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + ord(c)::BIGINT // 64, 128 + ord(c)::BIGINT % 64] END)) AS b
  FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce(b, lambda a, x: xor(a // 256, t[xor(a % 256, x) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM bytes, crc
), w AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                    ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6
  GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT word, n, i, left(word, i) AS a, substr(word, i + 2) AS z
  FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM w)
), near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM cut x JOIN cut y USING (a, z) WHERE x.word <> y.word
  UNION
  SELECT c.word, w.word, w.n FROM cut c JOIN w ON w.word = c.a || c.z
  UNION
  SELECT w.word, c.word, c.n FROM cut c JOIN w ON w.word = c.a || c.z
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n
  FROM near GROUP BY word
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
         CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM f JOIN chain c ON c.word = f.word AND c.next IS NULL"""
