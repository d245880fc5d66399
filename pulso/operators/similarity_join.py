"""Lossless similarity join of two sets of texts.

Two texts of lengths a and b whose measure reaches t share at least so many characters or q neighbours (both as multisets, repeats
numbered), with L the longer length and S = a + b:

* edit ratio 1 - d/L: d is at most (1 - t) L, each edit takes one character or q grams, so L - d characters and L - q + 1 - q d grams are shared;
* gestalt ratio 2 M / S: the M matched characters are shared, at least t S / 2; they stand in blocks, and between two blocks one of the texts has an unmatched
  character, so there are at most 1 + S - 2 M blocks and at least 3 M - 1 - S shared pairs.

A text that must share c of its n grams with a partner shares m of its n - c + m rarest with that partner's rarest, m up to c (prefix and count filter). So texts
meet on rare grams only, and on ``MEET`` of them: on pairs or triples if both are long enough for the bound on those to say something, else on characters. Grams that many keys begin with are split: the keys are
dealt to parts and a text asks every part. Who met is measured; before the gestalt ratio, which is costly, the shared characters of the pair are counted (count
filter). All bounds are necessary, so no pair is lost; where none holds (t near 0), every text with a character in common is a candidate.

Numbered names have no rare grams: a gram of digits stands in a fixed share of them, and texts that meet on one of those are a share of all pairs. So pairs
that the edit ratio allows one edit at most (by their longer text, of up to ``ONE_EDIT`` characters) meet on what is left of either when one character goes
instead: one edit apart means equal, or equal after that. Who meets so is two edits apart at most, however frequent the grams are. The other pairs meet on grams.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import levenshtein_ratio, ratcliff_from

# Length and overlap bounds only sort out candidates; the measure itself decides, so they may be wider than exact.
SLACK = 1e-6
LONGEST = 2048          # lengths looked at for the bound on longer grams
# Rare grams that two texts share, where the bound allows: more of them mean fewer pairs to measure, but more rows to find those.
MEET = {"levenshtein": 1, "ratcliff": 4}
POSTINGS = 4096         # keys of one gram that one part holds
ONE_EDIT = 128          # longer texts have as many shortened forms, each as long; they meet on grams
METRICS = ("ratcliff", "levenshtein")


def _shrink(t: float, metric: str) -> float:
    """Least length of a partner as a share of one's own."""
    return t / (2 - t) if metric == "ratcliff" else t


def _gram(t: float, metric: str) -> int:
    """Longer grams are rarer, but an edit takes more of them."""
    return 3 if metric == "levenshtein" and 3 * (1 - t) <= 0.8 else 2


def _least_shared(n: Column | int, t: float, metric: str, gram: int, ceil: Callable = F.ceil) -> Column | int:
    """How many characters (``gram`` 1) or longer grams a text of length n shares with any partner that reaches t.

    The bounds of a pair go up and down by whole edits or blocks with the partner's length; without that rounding they only grow with it, so the shortest
    partner gives a number that holds for all.
    """
    if metric == "ratcliff":
        both = n + ceil(n * _shrink(t, metric) - SLACK)
        return ceil(both * (t / 2) - SLACK) if gram == 1 else ceil(both * (1.5 * t - 1) - SLACK) - 1
    return ceil(n * (1 - gram * (1 - t)) - gram * SLACK) - (gram - 1)


def _numbered(text: Column, gram: int) -> Column:
    """The grams of a text, repeats told apart by their number."""
    n = F.length(text) - (gram - 1)
    grams = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, i, F.lit(gram)))).otherwise(F.array().cast("array<string>"))
    return F.transform(grams, lambda g, i: F.concat(g, F.size(F.filter(F.slice(grams, F.lit(1), i + 1), lambda x: x == g)).cast("string")))


def _meets_shortened(longer: Column, t: float, metric: str) -> Column:
    """Whether a pair with this longer length meets on shortened forms; true up to some length and false from there on."""
    if metric != "levenshtein":
        return F.lit(False)
    edits = F.floor(longer * F.lit(1 - t) + F.lit(SLACK))
    return (edits < 1) | ((edits == 1) & (longer <= F.lit(ONE_EDIT)))


def _shortened(texts: DataFrame, t: float) -> DataFrame:
    """(text, form): hashes of the text itself and, if a pair with it may have an edit, of the text without each of its characters."""
    text, n = F.col("text"), F.length("text")
    without = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, n)))
    some = F.floor((n + 1) * F.lit(1 - t) + F.lit(SLACK)) >= 1   # one edit changes the length by one at most
    # texts are few bytes beside their forms, so they are dealt out by number, not by size
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.filter((n > 0) & _meets_shortened(n, t, "levenshtein")).repartition(parts)
    forms = texts.select("text", F.explode(F.when(some & (n <= ONE_EDIT), F.array_distinct(F.concat(F.array(text), without))).otherwise(F.array(text))).alias("form"))
    # two texts of one character have nothing in common without it
    return forms.filter(F.col("form") != "").select("text", F.xxhash64("form").alias("form"))


def _met_shortened(probes: DataFrame, keys: DataFrame, t: float) -> DataFrame:
    """(probe, key): the pairs of one edit at most, and some of two; equal hashes of other forms are candidates too many."""
    asked, listed = (_shortened(side, t).withColumnRenamed("text", name) for side, name in ((probes, "probe"), (keys, "key")))
    a, b = F.length("probe"), F.length("key")
    longer = F.greatest(a, b)
    near = _meets_shortened(longer, t, "levenshtein") & (longer - F.least(a, b) <= F.floor(longer * F.lit(1 - t) + F.lit(SLACK)))
    # forms count as small before they are spread out, and would all be broadcast
    return asked.join(listed.hint("merge"), "form").filter(near).select("probe", "key").distinct()


def _graded(texts: DataFrame, t: float, metric: str) -> DataFrame:
    """(text, kind, grams, take, meet, long): longer grams (kind 2) of a text that is long enough for them, characters (1) of one that is not or may meet such a one.

    ``take`` is the number of rarest grams of which ``meet`` are shared with any partner.
    """
    texts = texts.filter(F.length("text") > 0).withColumn("n", F.length("text"))
    longest_partner = F.try_divide(F.col("n"), F.lit(_shrink(t, metric))) + F.lit(1)
    texts = texts.filter(F.coalesce(~_meets_shortened(longest_partner, t, metric), F.lit(True)))   # all others have no pair that meets on grams
    first_long = _first_long(t, metric)
    shortest_partner = F.ceil(F.col("n") * F.lit(_shrink(t, metric)) - F.lit(SLACK))
    kinds = F.filter(F.array(F.when(F.col("n") >= first_long, F.lit(2)), F.when(shortest_partner < first_long, F.lit(1))), lambda k: k.isNotNull())
    rows = texts.select("text", "n", F.explode(kinds).alias("kind"))
    q = _gram(t, metric)
    rows = rows.withColumn("grams", F.when(F.col("kind") == 2, _numbered(F.col("text"), q)).otherwise(_numbered(F.col("text"), 1)))
    least = F.when(F.col("kind") == 2, _least_shared(F.col("n"), t, metric, q)).otherwise(_least_shared(F.col("n"), t, metric, 1))
    least = F.greatest(least, F.lit(1)).cast("int")
    meet = F.least(least, F.lit(MEET[metric]))
    return rows.select("text", "kind", "grams", (F.size("grams") - least + meet).alias("take"), meet.alias("meet"), (F.col("n") >= first_long).alias("long"))


def _first_long(t: float, metric: str) -> int:
    """The length from which on the bound on longer grams says something; beyond all lengths if it does not for usual ones."""
    return next((n for n in range(1, LONGEST) if _least_shared(n, t, metric, _gram(t, metric), math.ceil) >= 1), 1 << 30)


def _prefixes(graded: DataFrame, rarity: DataFrame) -> DataFrame:
    """(text, long, kind, meet, gram): the rarest grams of every text."""
    of = ["text", "long", "kind", "meet"]
    ranked = (graded.select(*of, "take", F.explode("grams").alias("gram")).join(rarity, ["kind", "gram"], "left")
              .groupBy(*of, "take").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("ranked")))
    return ranked.select(*of, F.explode(F.slice("ranked", F.lit(1), F.greatest("take", F.lit(0)))).alias("g")).select(*of, "g.gram")


def near_lengths(probes: DataFrame, keys: DataFrame, threshold: float, metric: str) -> DataFrame:
    """(probe, key): all pairs of non-empty texts whose lengths allow the threshold, joined on the length."""
    n, shrink = F.length("text"), F.lit(_shrink(float(threshold), metric))
    longest = keys.agg(F.max(F.length("text"))).first()[0] or 0
    low = F.greatest(F.ceil(n * shrink - F.lit(SLACK)), F.lit(1)).cast("int")
    high = F.least(F.floor(F.try_divide(n, shrink) + F.lit(SLACK)), F.lit(longest)).cast("int")
    asked = probes.filter((n > 0) & (low <= F.coalesce(high, F.lit(longest)))).select(F.col("text").alias("probe"), F.explode(F.sequence(low, F.coalesce(high, F.lit(longest)))).alias("length"))
    return asked.join(keys.filter(n > 0).select(F.col("text").alias("key"), n.alias("length")), "length").select("probe", "key")


def candidates(probes: DataFrame, keys: DataFrame, threshold: float, metric: str) -> DataFrame:
    """(probe, key): all pairs of distinct non-empty texts (column ``text`` of either side) whose measure can reach the threshold."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    t = float(threshold)
    graded = [_graded(side, t, metric) for side in (probes, keys)]
    # The rarity of a gram is the number of keys that have it.
    rarity = graded[1].select("kind", F.explode("grams").alias("gram")).groupBy("kind", "gram").agg(F.count(F.lit(1)).alias("n"))
    asked, listed = (_prefixes(side, rarity) for side in graded)
    parts = listed.groupBy("kind", "gram").agg(F.ceil(F.count(F.lit(1)) / F.lit(POSTINGS)).cast("int").alias("parts"))
    on = ["kind", "gram"]
    listed = listed.join(parts, on).select(*on, F.col("text").alias("key"), F.col("long").alias("key_long"), F.col("meet").alias("key_meet"), F.pmod(F.xxhash64("text"), F.col("parts")).cast("int").alias("part"))
    asked = asked.join(parts, on).select(*on, F.col("text").alias("probe"), "long", "meet", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    a, b = F.length("probe"), F.length("key")
    near = F.least(a, b) >= F.greatest(a, b) * F.lit(_shrink(t, metric)) - F.lit(SLACK)
    # two long texts meet on longer grams, all others on characters
    met = asked.join(listed, [*on, "part"]).filter(near & ~_meets_shortened(F.greatest(a, b), t, metric) & ((F.col("kind") == 2) | ~F.col("long") | ~F.col("key_long")))
    met = (met.groupBy("probe", "key").agg(F.count(F.lit(1)).alias("n"), F.first(F.least("meet", "key_meet")).alias("enough"))
           .filter(F.col("n") >= F.col("enough")).select("probe", "key"))
    return met.unionByName(_met_shortened(probes, keys, t)) if metric == "levenshtein" else met


def scored(pairs: DataFrame, t: float, metric: str) -> DataFrame:
    """(probe, key, s): the pairs of ``candidates`` that reach the threshold, with their measure."""
    s = ratcliff_from(F.col("probe"), F.col("key"), t) if metric == "ratcliff" else levenshtein_ratio(F.col("key"), F.col("probe"))
    return pairs.withColumn("s", s).filter((F.col("s") >= F.lit(t)) & (F.col("s") > 0))
