"""Collocations by set-oriented mining: relations of occurrences, joined with themselves.

The occurrences of the frequent phrases of one length are a written relation, bucketed by
document and sorted by position. It is merge-joined with itself at adjacent positions, the pairs
are counted by group, and a semi-join with the frequent groups gives the relation of the next
length. Buckets meet without a shuffle; only counts are shuffled, summed up in each task before.
"""

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import functions as F

from tarmac.llm.common import settings, shuffle_partitions
from tarmac.operators.joins import BROADCAST_LIMIT, broadcast_if_small, measured_bytes
from tarmac.operators.ranking import with_rank
from tarmac.sources import stage

LONGEST, LEAST, TOP = 5, 100, 2000
NO_LANG = "und"
# Words for each bucket of the relations, and the most buckets that Spark writes.
BUCKET_WORDS, MOST_BUCKETS = 2_000_000, 100_000

# What ends a piece, and what parts its words.
_ENDS, _BLANKS = ".,;:!?\x0b\x0c\r", "[ \t]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(copy):
    """Every word with its position in the document; the end of a piece takes a position too.

    So two words stand at adjacent positions only if they follow one another in a piece.
    """
    text = F.translate("text", _UPPER + _ENDS, _LOWER + "\n" * len(_ENDS))
    tokens = F.split(F.replace(text, F.lit("\n"), F.lit(" \n ")), _BLANKS)
    return copy.select("rid", "lang", F.posexplode(tokens).alias("pos", "word")).where(
        "word NOT IN ('', '\n')"
    )


class _Relations:
    """Written relations of occurrences (rid, pos, gid), one bucket file after the other."""

    def __init__(self, spark, buckets):
        self.spark, self.buckets, self.names = spark, buckets, []

    def write(self, rows):
        name = f"occurrences_{uuid.uuid4().hex}"
        self.names.append(name)
        (
            rows.select("rid", "pos", "gid")
            .write.bucketBy(self.buckets, "rid")
            .sortBy("rid", "pos")
            .option("path", stage.new_stage_path(self.spark, name))
            .saveAsTable(name)
        )
        return self.spark.table(name)

    def drop(self):
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def _relations(spark, buckets):
    relations = _Relations(spark, buckets)
    try:
        yield relations
    finally:
        relations.drop()


def _adjacent(relation):
    """The relation merge-joined with itself at the next position: (rid, pos, left, right)."""
    left = relation.select("rid", "pos", F.col("gid").alias("left"))
    right = relation.select("rid", F.col("pos").alias("next"), F.col("gid").alias("right"))
    return left.join(
        right.hint("merge"), (left["rid"] == right["rid"]) & (left["pos"] + 1 == right["next"])
    ).select(left["rid"], "pos", "left", "right")


def _semi_join(rows, groups, on, buckets):
    """The rows of frequent groups with the group's number, in buckets again."""
    groups = groups.select(*on, "gid")
    if measured_bytes(groups)[0] <= BROADCAST_LIMIT:
        return rows.join(F.broadcast(groups), on)
    return rows.join(groups, on).repartition(buckets, "rid")


def _longer(counts, shorter):
    """Frequent phrases of one more word, from their counts and those of their two parts.

    ``firsts`` and ``lasts`` hold the counts of the first and of the last 1, 2, ... words.
    """
    left = shorter.select(
        F.col("gid").alias("left"), "lang", F.col("phrase").alias("start"), "firsts"
    )
    right = shorter.select(F.col("gid").alias("right"), F.col("last").alias("word"), "lasts")
    return (
        counts.join(left, "left")
        .join(right, "right")
        .select(
            F.monotonically_increasing_id().alias("gid"),
            "left",
            "right",
            "lang",
            F.concat_ws(" ", "start", "word").alias("phrase"),
            F.col("word").alias("last"),
            "a",
            F.concat("firsts", F.array("a")).alias("firsts"),
            F.concat("lasts", F.array("a")).alias("lasts"),
        )
    )


def _best_cut(words):
    """The cut of least score, of equal ones the earliest, as (score, k, l, r); exact."""
    cuts = []
    for k in range(1, words):
        first, rest = F.col("firsts")[k - 1], F.col("lasts")[words - k - 1]
        exact = [c.cast("decimal(20,0)") for c in (F.col("a"), F.col("n"), first, rest)]
        score = F.call_function("div", 1000 * exact[0] * exact[1], exact[2] * exact[3])
        cuts.append(
            F.struct(
                score.cast("long").alias("score"),
                F.lit(k).alias("k"),
                first.alias("l"),
                rest.alias("r"),
            )
        )
    return F.array_min(F.array(*cuts))


def _not_covered(phrases, longer):
    """Phrases that are rarer inside every longer one.

    One more word is enough to look at: what holds a phrase as often as it occurs, holds it in a
    phrase of one more word that occurs as often.
    """
    covers = longer.select(F.col("left").alias("gid"), F.col("a").alias("of")).union(
        longer.select("right", "a")
    )
    most = covers.groupBy("gid").agg(F.max("of").alias("of"))
    return phrases.join(most, "gid", "left").where("of IS NULL OR of < a").drop("of")


def collocations(
    docs, text="text", lang="lang", longest=LONGEST, least=LEAST, top=TOP, bucket_words=BUCKET_WORDS
):
    """Lang, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the best phrases.

    Phrases are 2 to ``longest`` adjacent words of one piece that occur ``least`` times or more;
    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of
    the language. A phrase that occurs as often inside a longer one is left out. Each language
    gets its ``top`` phrases by score, then count, then text.

    A null language is ``und`` and one with documents that say so. Null, empty and blank texts
    have no words; repeated rows count each; very long texts are pieces like others. An empty
    table gives an empty one; other columns play no part.
    """
    spark = docs.sparkSession
    path = stage.new_stage_path(spark, "collocations")
    keys = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        # Buckets by document also hold the rows of a document and position together.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    with stage.job(spark), settings(spark, **keys):
        copy = stage.keep(
            docs.select(
                F.monotonically_increasing_id().alias("rid"),
                F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"),
                F.coalesce(F.col(text), F.lit("")).alias("text"),
            ),
            "copy",
            "zstd",
        )
        counts = stage.keep(
            occurrences(copy).groupBy("lang", "word").agg(F.count("*").alias("a")), "words"
        )
        totals = stage.keep(counts.groupBy("lang").agg(F.sum("a").alias("n")), "totals")
        words = totals.agg(F.sum("n")).first()[0] or 0
        buckets = max(shuffle_partitions(spark), -(-words // bucket_words))
        frequent = stage.keep(
            counts.where(F.col("a") >= least).select(
                F.monotonically_increasing_id().alias("gid"),
                "lang",
                F.col("word").alias("phrase"),
                F.col("word").alias("last"),
                "a",
                F.array("a").alias("firsts"),
                F.array("a").alias("lasts"),
            ),
            "phrases",
        )
        phrases = [frequent]
        with _relations(spark, min(buckets, MOST_BUCKETS)) as relations:
            dealt = copy.repartition(relations.buckets, "rid")
            named = frequent.withColumn("word", F.col("phrase"))
            relation = relations.write(
                _semi_join(occurrences(dealt), named, ["lang", "word"], relations.buckets)
            )
            for length in range(2, longest + 1):
                pairs = _adjacent(relation)
                found = pairs.groupBy("left", "right").agg(F.count("*").alias("a"))
                found = stage.keep(found.where(F.col("a") >= least), "pairs")
                phrases.append(stage.keep(_longer(found, phrases[-1]), "phrases"))
                if length < longest:
                    relation = relations.write(
                        _semi_join(pairs, phrases[-1], ["left", "right"], relations.buckets)
                    )
        rows = []
        for length in range(2, longest + 1):
            own = phrases[length - 1]
            if length < longest:
                own = _not_covered(own, phrases[length])
            cut = own.join(broadcast_if_small(totals)[0], "lang").withColumn("cut", _best_cut(length))
            rows.append(cut.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        ranked = with_rank(reduce(lambda a, b: a.union(b), rows), order, ["lang"])
        ranked.where(F.col("rank") <= top).select(
            F.col("lang").alias(lang), "rank", "phrase", "a", "l", "r", "n", "score"
        ).write.parquet(path)
    return spark.read.parquet(path)
