"""Label matching: exact -> normalised -> fuzzy best match.

``match_labels`` resolves each left label to a value of a dimension
(question label -> question id, wanted name -> sheet/table name). Stages:

1. exact: label equals a dimension key;
2. normalised: C2(label) equals C2(key) (later dimension rows win a collision);
3. fuzzy: highest similarity of C2(label) to the C2 keys, ties -> first key
   in dimension order, accepted when >= threshold (optionally after a
   case-insensitive prefix test, for name resolution).

Two physical strategies with the same results at every size and in every mode
(a test sweeps thresholds and modes):

* inline (dimension size checked <= ``max_inline``): the dimension becomes a
  literal map / array in the plan and each row is resolved with native map
  lookups and higher-order functions — no join, no shuffle;
* joins (larger dimensions): exact, normalised and prefix stages are equi-joins (a key is listed under each of its
  prefixes); the fuzzy stage is the lossless join of ``similarity_join`` and keeps the best candidate with a
  map-side maximum per label. Low thresholds are asked for only where no near key is found.

A candidate without any similarity never matches, whatever the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import best_ratcliff_udf, levenshtein_ratio
from ..functions.text import norm_label, norm_label_loose, plain_label
from ..session import materialize
from .similarity_join import SLACK, candidates, near_lengths, scored

_MATCH_COLS = ("match_value", "match_method", "match_score")
# Candidate lists up to this size are scored as unrolled column expressions.
UNROLL_MAX = 256
# So few pairs of open labels and keys are measured as they are, by the lengths that can match; rarity of grams has nothing to say there.
FEW_PAIRS = 2000
# Below this threshold the bounds say little, so labels look for near keys first; one that has a key this near need not look further.
LOOSE, NEAR = 0.6, 0.9


def _probe(lab: Column, mode: str) -> Column:
    if mode not in ("label", "name", "best"):
        raise ValueError(f"unknown mode {mode!r}")
    return norm_label_loose(lab) if mode == "label" else norm_label(lab)


def _inline(labels: DataFrame, dim_rows: list[tuple[int, str, str]], threshold: float,
            metric: str, mode: str, sole_fallback: bool = False) -> DataFrame:
    """Resolve distinct labels (``__lab``, ``__probe``) against a literal, size-checked dimension."""
    lab = F.col("__lab")
    probe = F.col("__probe")
    rows = sorted(dim_rows)
    stages: list[tuple[str, Column]] = []
    if mode == "label":
        exact: dict[str, str] = {}
        fuzzy_keys: dict[str, tuple[int, str]] = {}
        for o, k, v in rows:
            exact[k] = v  # later rows win, as in a dict literal
            nk = plain_label(k, loose=True)
            first_ord = fuzzy_keys[nk][0] if nk in fuzzy_keys else o
            fuzzy_keys[nk] = (first_ord, v)  # position of first occurrence, value of the last
        stages.append(("exact", F.element_at(_lit_map(exact), lab)))
        stages.append(("normalized", F.element_at(_lit_map({k: v for k, (_, v) in fuzzy_keys.items()}), probe)))
    elif mode == "best":  # exact name, else the best fuzzy name (no threshold), else the first one
        fuzzy_keys = {}
        for o, k, v in rows:
            fuzzy_keys.setdefault(plain_label(k), (o, v))
        exact_name = {}
        for o, k, v in rows:
            exact_name.setdefault(k, v)
        stages.append(("exact", F.element_at(_lit_map(exact_name), lab)))
        threshold = 0.0
    else:  # "name": equality or prefix without case and accents, first dimension row wins
        fuzzy_keys = {}
        for o, k, v in rows:
            fuzzy_keys.setdefault(plain_label(k), (o, v))
        pref = None
        for o, k, v in rows:
            kk = plain_label(k)
            cond = (probe == F.lit(kk)) | F.startswith(F.lit(kk), probe)
            pref = F.when(cond, F.lit(v)) if pref is None else pref.when(cond, F.lit(v))
        stages.append(("prefix", pref if pref is not None else F.lit(None).cast("string")))

    cands = sorted((o, k, v) for k, (o, v) in fuzzy_keys.items())
    t = F.lit(float(threshold))
    # ``top``: struct(s, neg_o, v) of the best candidate reaching the threshold,
    # or NULL. Candidates below it are NULL structs, which greatest/array_max
    # skip, so the winner is the same as "best overall, then threshold".
    if not cands:
        top = F.lit(None).cast("struct<s:double,neg_o:bigint,v:string>")
    elif metric == "ratcliff":
        best = best_ratcliff_udf(cands, threshold)(probe)
        top = F.when(best["score"] >= t, F.struct(best["score"].alias("s"), (-best["ord"]).alias("neg_o"),
                                                  best["value"].alias("v")))
    else:
        plen = F.length(probe)

        def cand(k: Column, n: Column, o: Column, v: Column) -> Column:
            # Keys whose length cannot reach the threshold (min/max < t) are
            # skipped without running the edit distance.
            ok = F.least(n, plen) >= F.greatest(n, plen) * t - F.lit(SLACK)
            sc = levenshtein_ratio(k, probe)
            return F.when(ok & (sc >= t) & (sc > 0), F.struct(sc.alias("s"), (-o).alias("neg_o"), v.alias("v")))

        if len(cands) <= UNROLL_MAX:
            # Unrolled: one plain expression per candidate, all inside codegen.
            structs = [cand(F.lit(k), F.lit(len(k)), F.lit(o).cast("bigint"), F.lit(v)) for o, k, v in cands]
            top = F.greatest(*structs) if len(structs) > 1 else structs[0]
        else:
            arr = F.array(*[F.struct(F.lit(o).cast("bigint").alias("o"), F.lit(k).alias("k"), F.lit(len(k)).alias("n"),
                                     F.lit(v).alias("v")) for o, k, v in cands])
            top = F.array_max(F.filter(F.transform(arr, lambda e: cand(e["k"], e["n"], e["o"], e["v"])),
                                       lambda x: x.isNotNull()))

    stage_cols = [c for _, c in stages]
    none_before = F.lit(True)
    for c in stage_cols:
        none_before = none_before & c.isNull()
    fallback = None
    if rows and (mode == "best" or (mode == "name" and sole_fallback and len(rows) == 1)):
        fallback = F.lit(sorted(rows)[0][2])  # first (or only) candidate
    value = F.coalesce(*stage_cols, top["v"], *([F.when(lab.isNotNull(), fallback)] if fallback is not None else []))
    method = None
    for name, c in stages:
        method = F.when(c.isNotNull(), F.lit(name)) if method is None else method.when(c.isNotNull(), F.lit(name))
    method = method.when(top.isNotNull(), F.lit("fuzzy"))
    if fallback is not None:
        method = method.when(lab.isNotNull(), F.lit("fallback"))
    score = F.when(none_before, top["s"])
    return labels.select("__lab", value.alias("match_value"), method.alias("match_method"),
                         score.alias("match_score"))


def _lit_map(d: dict[str, str]) -> Column:
    if not d:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[x for kv in d.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])


def _joined(labels: DataFrame, dim: DataFrame, threshold: float, metric: str, mode: str,
            sole_fallback: bool) -> DataFrame:
    """Resolve distinct labels (``__lab``, ``__probe``) against a dimension (o, k, v) of any size, by joins."""
    row = F.struct("o", "k", "v")
    keys = dim.withColumn("nk", _probe(F.col("k"), mode))
    if mode == "label":   # the last row of a key wins, at the place of its first one
        exact = dim.groupBy(F.col("k").alias("__e")).agg(F.max(row)["v"].alias("__ev"))
        folded = keys.groupBy("nk").agg(F.min("o").alias("no"), F.max(row)["v"].alias("nv"))
        early = folded.select(F.col("nk").alias("__n"), F.col("nv").alias("__nv"))
    else:                 # the first row of a key wins
        exact = dim.groupBy(F.col("k").alias("__e")).agg(F.min(row)["v"].alias("__ev"))
        folded = keys.groupBy("nk").agg(F.min("o").alias("no"), F.min(row)["v"].alias("nv"))
        prefixes = keys.withColumn("__n", F.explode(F.transform(F.sequence(F.lit(0), F.length("nk")),
                                                                lambda i: F.substring(F.col("nk"), F.lit(1), i))))
        early = prefixes.groupBy("__n").agg(F.min(row)["v"].alias("__nv"))
    early_name = "normalized" if mode == "label" else "prefix"
    none = F.lit(None).cast("string")
    found = labels.join(exact, labels["__lab"] == exact["__e"], "left") if mode != "name" else labels.withColumn("__ev", none)
    found = found.join(early, found["__probe"] == early["__n"], "left") if mode != "best" else found.withColumn("__nv", none)
    found = found.select("__lab", "__probe", "__ev", "__nv")

    t = 0.0 if mode == "best" else float(threshold)
    open_ = materialize(found.filter(F.col("__ev").isNull() & F.col("__nv").isNull()).select("__lab", "__probe"), "match-open")
    keyed = materialize(folded, "match-keys")
    best = None
    if t < LOOSE:
        best = materialize(_nearest(open_, keyed, NEAR, metric), "match-nearest")
        open_ = open_.join(best.select("__lab"), "__lab", "left_anti")
    rest = _nearest(open_, keyed, t, metric)
    best = rest if best is None else best.unionByName(rest)
    fallback = none
    if mode == "best" or (mode == "name" and sole_fallback):
        size, first = dim.agg(F.count(F.lit(1)), F.min(row)).first()
        if size and (mode == "best" or size == 1):
            fallback = F.lit(first["v"])
    out = found.join(best, "__lab", "left")
    before = F.col("__ev").isNull() & F.col("__nv").isNull()
    method = (F.when(F.col("__ev").isNotNull(), "exact").when(F.col("__nv").isNotNull(), early_name)
              .when(F.col("__top").isNotNull(), "fuzzy").when(fallback.isNotNull(), "fallback"))
    return out.select("__lab", F.coalesce("__ev", "__nv", "__top.v", fallback).alias("match_value"),
                      method.alias("match_method"), F.when(before, F.col("__top.s")).alias("match_score"))


def _nearest(labels: DataFrame, keyed: DataFrame, t: float, metric: str) -> DataFrame:
    """(__lab, __top): the best key of every label that has one with a score of t or more."""
    probes, keys = labels.select(F.col("__probe").alias("text")).distinct(), keyed.select(F.col("nk").alias("text"))
    few = labels.count() * keyed.count() <= FEW_PAIRS
    pairs = near_lengths(probes, keys, t, metric) if few else candidates(probes, keys, t, metric)
    near = scored(pairs, t, metric)
    best = (near.join(keyed, near["key"] == keyed["nk"])
            .groupBy("probe").agg(F.max(F.struct(F.col("s"), (-F.col("no")).alias("neg_o"), F.col("nv").alias("v"))).alias("__top")))
    return labels.join(best, labels["__probe"] == best["probe"]).select("__lab", "__top")


def match_labels(left: DataFrame, label_col: str, dim: DataFrame, key_col: str = "label",
                 value_col: str = "question_id", ord_col: str = "ord", threshold: float = 0.75,
                 metric: str = "ratcliff", mode: str = "label", max_inline: int = 5000,
                 sole_fallback: bool = False) -> DataFrame:
    """Add match_value / match_method / match_score to ``left``.

    ``mode``: "label" (exact -> normalised -> fuzzy >= threshold), "name"
    (equality/prefix without case and accents -> fuzzy >= threshold; with
    ``sole_fallback`` a one-row candidate list matches anything left) or "best"
    (exact -> best fuzzy without threshold -> first candidate).

    ``metric``: "ratcliff" (reference ratio, pandas UDF) or "levenshtein"
    (native). The dimension is inlined only after its row count is checked.
    """
    if metric not in ("ratcliff", "levenshtein"):
        raise ValueError(f"unknown metric {metric!r}")
    _probe(F.lit(""), mode)  # rejects unknown modes
    lab = F.col(label_col).cast("string")
    # One bounded job both checks the size and fetches an inline-sized dimension:
    # at most max_inline + 1 rows ever reach the driver.
    fetched = (dim.select(F.col(ord_col).cast("bigint").alias("o"), F.col(key_col).cast("string").alias("k"),
                          F.col(value_col).cast("string").alias("v"))
               .filter(F.col("k").isNotNull()).limit(max_inline + 1).collect())
    if len(fetched) <= max_inline:
        rows = [(int(r[0]), r[1], r[2]) for r in fetched]
        # Resolve each distinct label once. The normalised probe is a grouping
        # key, so the aggregate materialises it and the per-candidate scoring
        # reads a column instead of re-deriving it; the result is joined back
        # on the label (AQE broadcasts it when the distinct set is small).
        labels = left.select(lab.alias("__lab"), _probe(lab, mode).alias("__probe")).distinct()
        res = _inline(labels, rows, threshold, metric, mode, sole_fallback)
        return left.join(res, lab.eqNullSafe(res["__lab"]), "left").drop("__lab")
    labels = (left.select(lab.alias("__lab"), _probe(lab, mode).alias("__probe"))
              .filter(F.col("__lab").isNotNull()).distinct())
    keyed = dim.select(F.col(ord_col).cast("bigint").alias("o"), F.col(key_col).cast("string").alias("k"),
                       F.col(value_col).cast("string").alias("v")).filter(F.col("k").isNotNull())
    res = _joined(labels, keyed, threshold, metric, mode, sole_fallback)
    return left.join(res, lab == res["__lab"], "left").drop("__lab")


def unmatched(matched: DataFrame) -> DataFrame:
    """The left rows without a match (anti join on the match result)."""
    return matched.filter(F.col("match_value").isNull()).drop(*_MATCH_COLS)
