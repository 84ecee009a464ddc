"""Universe maps, issuer links, set differences and precedence joins."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from riskloom.operators.bitemporal import merge_intervals, overlap_join, valid_on
from riskloom.operators.graph import components, roots
from riskloom.session import spread, stored


def rmg_map(univ: DataFrame, listings: DataFrame, key: str, dt: str = "dt") -> DataFrame:
    """Market each asset trades in on each date, from listing validity."""
    return valid_on(univ, listings, [key], dt).drop("from_dt", "thru_dt")


def home_markets(univ: DataFrame, sources: Sequence[DataFrame], key: str, trading: str = "market") -> DataFrame:
    """Home market by precedence of sources (key, home), else the trading market; flags foreign."""
    out = univ
    names = []
    for i, s in enumerate(sources):
        out = out.join(s.select(key, F.col("home").alias(f"_h{i}")), key, "left")
        names.append(F.col(f"_h{i}"))
    out = out.withColumn("home", F.coalesce(*names, F.col(trading)))
    return out.withColumn("is_foreign", F.col("home") != F.col(trading)).drop(*[f"_h{i}" for i in range(len(sources))])


def linkage(assets: DataFrame, company: DataFrame, dual_listed: DataFrame, clones: DataFrame, key: str) -> DataFrame:
    """Company, merged dual-listed group, number of sibling lines and clone master per asset.

    Dual-listed groups are given (company, group); no graph closure is needed.
    """
    j = assets.join(company.select(key, "company"), key, "left")
    # lines without a company meet no join on the null
    none = j.where(F.col("company").isNull()).withColumns({"link_id": F.col("company"), "n_lines": F.lit(None).cast("bigint")})
    j = j.where(F.col("company").isNotNull()).join(dual_listed.select("company", "dual_group"), "company", "left")
    j = j.withColumn("link_id", F.coalesce(F.col("dual_group"), F.col("company")))
    size = j.groupBy("link_id").agg(F.count("*").alias("n_lines"))
    j = j.join(size, "link_id").select(*none.columns).unionByName(none).join(clones.select(key, F.col("master").alias("clone_of")), key, "left")
    return j.select(key, "company", "link_id", "n_lines", "clone_of")


def group_linked(lines: DataFrame, issuer: str, key: str, rules: Sequence[Column]) -> DataFrame:
    """Clusters of an issuer's lines that agree on every rule; single lines stand alone.

    Output keeps one row per line with ``cluster`` and its ``size``.
    """
    tag = F.concat_ws("|", *[F.coalesce(r.cast("string"), F.lit("")) for r in rules])
    x = lines.withColumn("cluster", tag)
    size = x.groupBy(issuer, "cluster").agg(F.count("*").alias("size"))
    return x.join(size, [issuer, "cluster"])


def linked_subgroups(lines: DataFrame, links: DataFrame, issuer: str, key: str, market: str, kind: str, main: Sequence[str], preferred: Sequence[str]) -> DataFrame:
    """Subgroups of each issuer's lines whose specific returns are treated together: lines with ``cluster`` and ``size``.

    A line of a ``main`` type is in its market's main cluster, a preferred one alone, any other with those of its
    type and market. ``links`` (key, master, link) go inside an issuer: a line linked to a master as ``dr``,
    ``clone`` or ``forced`` is in the cluster in which the chain of its masters ends; a ``soft`` one is in none, and
    nor is one whose chain runs in a circle or ends at such a line. A link to another issuer's line does not count.
    """
    own = lines.select(issuer, key)
    inside = links.select(key, "master", "link").join(own, key).join(own.select(F.col(issuer), F.col(key).alias("master")), [issuer, "master"])
    end = roots(inside.where("link <> 'soft'").select(key, "master").groupBy(key).agg(F.min("master").alias("master")), key, "master")
    soft = inside.where("link = 'soft'").select(key).distinct().withColumn("_soft", F.lit(True))
    tag = F.when(F.col(kind).isin(*main), F.lit("main")).when(F.col(kind).isin(*preferred), F.col(key).cast("string")).otherwise(F.coalesce(F.col(kind).cast("string"), F.lit("")))
    x = lines.join(soft, key, "left").withColumn("_tag", F.when(F.col("_soft").isNull(), F.concat_ws("|", F.coalesce(F.col(market).cast("string"), F.lit("")), tag))).drop("_soft")
    base = x.select(F.col(key).alias("root"), F.col("_tag").alias("_root_tag"))
    x = x.join(end.withColumn("_linked", F.lit(True)), key, "left").join(base, "root", "left")
    x = x.withColumn("cluster", F.when(F.col("_linked") & F.col("_tag").isNotNull(), F.col("_root_tag")).otherwise(F.col("_tag"))).drop("_tag", "_root_tag", "_linked", "root")
    size = x.where("cluster is not null").groupBy(issuer, "cluster").agg(F.count("*").alias("size"))
    return x.join(size, [issuer, "cluster"], "left")


def merged_groups(lines: DataFrame, links: DataFrame, dual: DataFrame, issuer: str, key: str) -> DataFrame:
    """(issuer, line, merged): the smallest issuer that an issuer is connected with by shared lines, by links between
    lines (key, master) of two issuers, or by pairs of dual-listed issuers (a, b)."""
    first = lines.groupBy(key).agg(F.min(issuer).alias("a"))  # issuers of one line, each with the smallest
    shared = lines.join(first, key).select("a", F.col(issuer).alias("b"))
    linked = links.select(key, "master").join(first, key).join(first.select(F.col(key).alias("master"), F.col("a").alias("b")), "master").select("a", "b")
    edges = shared.union(linked).union(dual.select("a", "b"))
    return lines.join(components(edges).select(F.col("node").alias(issuer), F.col("root").alias("merged")), issuer).select(issuer, key, "merged")


def issuer_cap(lines: DataFrame, dlc: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Cap of the issuer for every line.

    ``lines``: company, asset_id, cap, excluded, country, is_dr. One line gives its cap; all
    lines excluded give the largest; else the largest over countries of the sum of the lines
    that count, where receipts drop out beside ordinary lines and a zero sum falls back to
    all lines. With ``dlc`` (company, dual_group), ``dlc_cap`` adds up the linked companies.
    """
    by = list(by)
    n = F.count("*")
    ok, dr, cap = ~F.col("excluded"), F.col("is_dr"), F.coalesce(F.col("cap"), F.lit(0.0))
    s = lambda cond: F.coalesce(F.sum(F.when(cond, cap)), F.lit(0.0))
    c = lines.groupBy(*by, "company", "country").agg(
        n.alias("n"),
        F.sum(F.when(ok, 1).otherwise(0)).alias("n_ok"),
        F.sum(F.when(ok & ~dr, 1).otherwise(0)).alias("n_plain"),
        F.sum(cap).alias("all_cap"),
        s(ok & ~dr).alias("plain_cap"),
        s(ok).alias("ok_cap"),
        F.max(cap).alias("max_cap"),
    )
    counted = F.when(F.col("n_plain") > 0, F.col("plain_cap")).otherwise(F.col("ok_cap"))
    value = (
        F.when(F.col("n") == 1, F.col("all_cap"))
        .when(F.col("n_ok") == 0, F.lit(0.0))
        .when(counted == 0, F.col("all_cap"))
        .otherwise(counted)
    )
    tot = c.withColumn("_v", value).groupBy(*by, "company").agg(
        F.sum("n").alias("_n"), F.sum("n_ok").alias("_ok"), F.max("_v").alias("_m"), F.max("max_cap").alias("_x")
    )
    tot = tot.select(*by, "company", F.when(F.col("_ok") == 0, F.col("_x")).otherwise(F.col("_m")).alias("total_cap"))
    if dlc is not None:
        t = tot.join(dlc.select("company", "dual_group"), "company", "left").withColumn(
            "_g", F.coalesce(F.col("dual_group").cast("string"), F.concat(F.lit("c:"), F.col("company").cast("string")))
        )
        sums = t.groupBy(*by, "_g").agg(F.sum("total_cap").alias("dlc_cap"))
        tot = t.join(sums, [*by, "_g"]).drop("_g", "dual_group")
    return lines.join(tot, [*by, "company"])


def merge_countries(c: Column, groups: dict[str, Sequence[str]]) -> Column:
    """Country codes treated as one place under a joint name."""
    for name, codes in groups.items():
        c = F.when(c.isin(*codes), F.lit(name)).otherwise(c)
    return c


def combine_first(a: DataFrame, b: DataFrame, keys: Sequence[str], drop_left: Sequence[str] = ()) -> DataFrame:
    """Union of rows and columns, left value unless null; ``drop_left`` columns come from the right."""
    keys = list(keys)
    a = a.drop(*drop_left)
    cols = list(dict.fromkeys([c for c in [*a.columns, *b.columns] if c not in keys]))
    l = a.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in a.columns if c not in keys])
    r = b.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in b.columns if c not in keys])
    have_l, have_r = set(a.columns), set(b.columns)
    pick = [
        F.coalesce(*([F.col(f"_l_{c}")] if c in have_l else []), *([F.col(f"_r_{c}")] if c in have_r else [])).alias(c)
        for c in cols
    ]
    return l.join(r, keys, "full_outer").select(*keys, *pick)


def cross_listings(univ: DataFrame, isin: str, key: str, market: str, order: str | None = None) -> DataFrame:
    """Lines that share an identifier across markets, each against the group's primary line.

    The primary is the line with the greatest ``order`` (else the smallest id). One row per
    other line in another market, never all pairs of a group.
    """
    by = F.struct(F.col(order) if order else F.lit(0), -F.col(key))
    prim = univ.groupBy(isin).agg(F.max_by(F.struct(F.col(key), F.col(market)), by).alias("_p"), F.count("*").alias("_n")).where("_n > 1")
    j = univ.join(prim, isin).where((F.col(market) != F.col(f"_p.{market}")) & (F.col(key) != F.col(f"_p.{key}")))
    return j.select(isin, F.col(f"_p.{key}").alias("primary_id"), F.col(key).alias("other_id"), F.col(market).alias("other_market"))


def depository_receipts(univ: DataFrame, underlying: DataFrame, key: str, type_col: str, types: Sequence[str]) -> DataFrame:
    """Assets of receipt types with their underlying line's home currency."""
    return univ.where(F.col(type_col).isin(*types)).join(underlying, key, "left")


def share_classes(lines: DataFrame, issuer: str, key: str, class_col: str, order: Sequence[str], cap: str) -> DataFrame:
    """The chosen line per issuer: first by class order, then cap, then id; others flagged."""
    place = F.lit(len(order))
    for i, c in reversed(list(enumerate(order))):
        place = F.when(F.col(class_col) == c, F.lit(i)).otherwise(place)
    best = lines.groupBy(issuer).agg(F.max_by(key, F.struct(-place, F.col(cap), -F.col(key))).alias("_best"))
    return lines.join(best, issuer).withColumn("chosen", F.col(key) == F.col("_best")).drop("_best")


def leavers(prev: DataFrame, curr: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Members of the previous universe that are not in the current one, counted per ``by``."""
    return prev.join(curr.select(*keys), list(keys), "left_anti").groupBy(*by).agg(F.count("*").alias("n_leavers"))


def join_leave(prev: DataFrame, curr: DataFrame, key: str, details: Sequence[str]) -> DataFrame:
    """Joiners and leavers with details from the side that has them."""
    p = prev.select(key, *[F.col(c).alias(f"_p_{c}") for c in details], F.lit(True).alias("_p"))
    c = curr.select(key, *[F.col(c).alias(f"_c_{c}") for c in details], F.lit(True).alias("_c"))
    j = p.join(c, key, "full_outer").where("_p is null or _c is null")
    status = F.when(F.col("_p").isNull(), "joiner").otherwise("leaver")
    return j.select(key, status.alias("status"), *[F.coalesce(f"_c_{d}", f"_p_{d}").alias(d) for d in details])


def missing_from(univ: DataFrame, refs: dict[str, DataFrame], key: str) -> DataFrame:
    """Members of each reference set that the universe lacks."""
    out = None
    for name, r in refs.items():
        m = r.select(key).distinct().join(univ.select(key), key, "left_anti").withColumn("source", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out


def compare_estu(a: DataFrame, b: DataFrame, key: str, cap: str, dt: str = "dt") -> DataFrame:
    """Counts and caps common to two universes and held by one only, per date."""
    j = a.select(key, dt, F.col(cap).alias("_a")).join(b.select(key, dt, F.col(cap).alias("_b")), [key, dt], "full_outer")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    left, right = F.col("_b").isNull(), F.col("_a").isNull()
    cnt = lambda c, n: F.sum(F.when(c, 1).otherwise(0)).alias(n)
    tot = lambda c, v, n: F.coalesce(F.sum(F.when(c, F.col(v))), F.lit(0.0)).alias(n)
    return j.groupBy(dt).agg(
        cnt(both, "n_common"), cnt(left, "n_left"), cnt(right, "n_right"),
        tot(both, "_a", "cap_common"), tot(left, "_a", "cap_left"), tot(right, "_b", "cap_right"),
    )


def interval_faults(intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overlaps and gaps between an id's consecutive intervals."""
    w = W.partitionBy(*keys).orderBy("from_dt", "thru_dt")
    x = intervals.withColumn("prev_thru", F.lag("thru_dt").over(w))
    fault = F.when(F.col("prev_thru") > F.col("from_dt"), "overlap").when(F.col("prev_thru") < F.col("from_dt"), "gap")
    return x.withColumn("fault", fault).where("fault is not null").select(*keys, "from_dt", "prev_thru", "fault")


def identifier_clashes(ids: DataFrame, identifier: str, key: str) -> DataFrame:
    """Identifiers carried by more than one id."""
    g = ids.groupBy(identifier).agg(F.min(key).alias("first_id"), F.max(key).alias("last_id"), F.count("*").alias("n_rows"))
    return g.where("first_id <> last_id")


def tighten(intervals: DataFrame, prices: DataFrame, key: str, dt: str = "dt") -> DataFrame:
    """Intervals moved to the range in which the id has prices; unpriced ids drop out."""
    r = prices.groupBy(key).agg(F.min(dt).alias("_lo"), F.date_add(F.max(dt), 1).alias("_hi"))
    j = intervals.join(r, key)
    out = j.withColumn("from_dt", F.greatest("from_dt", "_lo")).withColumn("thru_dt", F.least("thru_dt", "_hi"))
    return out.where("from_dt < thru_dt").drop("_lo", "_hi")


def map_by_prefix(const: DataFrame, rules: DataFrame, code: str, prefix: str, target: str, lengths: Sequence[int]) -> DataFrame:
    """Target industry by the longest matching code prefix.

    One equality join per prefix length, so the rule table need not be small.
    """
    out = const
    for n in sorted(lengths, reverse=True):
        r = rules.where(F.length(prefix) == n).select(F.col(prefix).alias(f"_p{n}"), F.col(target).alias(f"_t{n}"))
        out = out.withColumn(f"_p{n}", F.substring(F.col(code), 1, n)).join(r, f"_p{n}", "left")
    pick = F.coalesce(*[F.col(f"_t{n}") for n in sorted(lengths, reverse=True)])
    return out.withColumn(target, pick).drop(*[f"_p{n}" for n in lengths], *[f"_t{n}" for n in lengths])


def priority(sources: Sequence[DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    """First non-null value among sources, in order, with the number of the source used."""
    keys = list(keys)
    tagged = None
    for i, s in enumerate(sources):
        t = s.where(F.col(value).isNotNull()).select(*keys, F.col(value), F.lit(i).alias("source"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.groupBy(*keys).agg(F.min_by(value, "source").alias(value), F.min("source").alias("source"))


def prefer_override(base: DataFrame, history: DataFrame, key: str, value: str, cutoff, preferred: Sequence[str], only_from: Sequence[str] = ()) -> DataFrame:
    """Preferred industry where the asset sits there on the first date after a cut-off."""
    d = F.lit(cutoff).cast("date")
    near = history.where(F.col("dt") >= d).groupBy(key).agg(F.min_by(value, "dt").alias("_near"))
    j = base.join(near, key, "left")
    use = F.col("_near").isin(*preferred)
    if only_from:
        use = use & F.col(value).isin(*only_from)
    return j.withColumn(value, F.when(use, F.col("_near")).otherwise(F.col(value))).drop("_near")


def best_match(pairs: DataFrame, key: str, other: str, order: Sequence[Column]) -> DataFrame:
    """Champion per key among candidate pairs, by a list of keys to minimise."""
    rest = [c for c in pairs.columns if c != key]
    pick = F.min_by(F.struct(*rest), F.struct(*order, F.col(other))).alias("_r")
    return pairs.groupBy(key).agg(pick).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def match_funds(
    funds: DataFrame, indexes: DataFrame, fund: str, index: str, step: str, ret: str, least: int = 12, threshold: float | None = None, k: int = 1, fund_info: DataFrame | None = None, index_info: DataFrame | None = None, block: int = 512
) -> DataFrame:
    """The ``k`` indexes that each fund follows best: fund, index, te, n, place, candidates.

    ``te`` is the sample deviation of the fund's return less the index's over their common steps (``least`` at
    least). ``fund_info`` (fund, countries, n_assets) and ``index_info`` likewise, where given: only indexes of the
    same set of countries count, and of equal te the one nearest in assets, then the smaller index, comes first.
    Indexes are a stated set that each fund is held against, in blocks: tasks hold ``block`` indexes' histories as a
    matrix and multiply it with the funds' that Spark deals to them, so neither pairs of histories nor their
    steps are joined. Where both have every step, deviations that lie further apart than the best ``te`` so far
    cannot match (the distance of two histories is at least the difference of their lengths) and are not computed;
    ``candidates`` counts the pairs that were. Each block gives its best ``k`` a fund, the last step the best of these.
    """
    spark = funds.sparkSession
    steps = [r[0] for r in indexes.where(F.col(ret).isNotNull()).select(step).distinct().orderBy(step).collect()]
    place = {s: i for i, s in enumerate(steps)}
    calendar = spark.createDataFrame([(s, i) for s, i in place.items()], T.StructType([indexes.schema[step], T.StructField("_i", T.IntegerType())])) if steps else None
    ft, it = funds.schema[fund].dataType.simpleString(), indexes.schema[index].dataType.simpleString()
    schema = f"`{fund}` {ft}, `{index}` {it}, te double, n int, off bigint, candidates bigint"
    if calendar is None:
        return spark.createDataFrame([], f"`{fund}` {ft}, `{index}` {it}, te double, n int, place int, candidates bigint")

    def histories(df: DataFrame, key: str, info: DataFrame | None) -> DataFrame:
        h = df.where(F.col(ret).isNotNull()).join(F.broadcast(calendar), step).groupBy(F.col(key).alias("_key"), "_i").agg(F.avg(ret).cast("double").alias("_r"))
        h = h.groupBy("_key").agg(F.collect_list("_i").alias("_at"), F.collect_list("_r").alias("_x"))
        if info is None:
            return h.select("_key", "_at", "_x", F.lit(None).cast("string").alias("_places"), F.lit(0).cast("bigint").alias("_size"))
        tag = F.concat_ws("|", F.array_sort(F.array_distinct(F.col("countries").cast("array<string>"))))
        return h.join(info.select(F.col(key).alias("_key"), tag.alias("_places"), F.col("n_assets").cast("bigint").alias("_size")), "_key", "left")

    ih = stored(histories(indexes, index, index_info))
    n_blocks = max(1, -(-ih.count() // block))
    fh = stored(histories(funds, fund, fund_info))
    by_info = fund_info is not None
    width = len(steps)
    out = None
    for b in range(n_blocks):
        mine = ih.where(F.pmod(F.xxhash64("_key"), F.lit(n_blocks)) == b).collect()  # about ``block`` histories of the calendar's length
        shared = spark.sparkContext.broadcast([(r["_key"], r["_at"], r["_x"], r["_places"], r["_size"]) for r in mine])
        part = fh.mapInArrow(_against(shared, width, least, threshold, k, by_info, fund, index), schema)
        out = part if out is None else out.unionByName(part)
    rank = W.partitionBy(fund).orderBy("te", "off", index)
    pairs = out.groupBy(fund).agg(F.sum("candidates").alias("candidates"))
    best = out.where(F.col("te").isNotNull()).withColumn("place", F.row_number().over(rank)).where(F.col("place") <= k).drop("candidates", "off")
    return best.join(pairs, fund).select(fund, index, "te", "n", "place", "candidates")


#: Indexes that a fund is held against at once, nearest deviations first.
GROUP = 8


def _against(shared, width: int, least: int, threshold: float | None, k: int, by_info: bool, fund: str, index: str):
    def run(batches):
        held = shared.value
        x, seen = np.zeros((len(held), width)), np.zeros((len(held), width))
        for j, (_, at, r, _, _) in enumerate(held):
            x[j, at], seen[j, at] = r, 1.0
        whole = seen.sum(axis=1) == width
        sd = np.array([np.std(r, ddof=1) if len(r) > 1 else np.nan for r in x])
        places, size = np.array([h[3] or "" for h in held], object), np.array([h[4] or 0 for h in held], np.int64)
        names = [h[0] for h in held]
        order_of = np.argsort(np.argsort(names, kind="stable"), kind="stable") if names else np.zeros(0, int)
        for b in batches:
            rows = []
            for key, at, r, tag, assets in zip(*(c.to_pylist() for c in b.columns)):
                y, m = np.zeros(width), np.zeros(width)
                y[at], m[at] = r, 1.0
                cand = np.flatnonzero(places == (tag or "")) if by_info else np.arange(len(held))
                full = len(at) == width
                off = np.abs(size[cand] - (assets or 0))
                count = 0
                if full and width > 1:  # nearest deviations first; the rest is cut off by the bound
                    gap = np.where(whole[cand], np.abs(sd[cand] - np.std(y, ddof=1)), 0.0)
                else:
                    gap = np.zeros(len(cand))
                order = np.argsort(gap, kind="stable")
                kept: list[tuple[float, int, int, int]] = []
                for s in range(0, len(order), GROUP):
                    group = order[s : s + GROUP]
                    limit = kept[k - 1][0] if len(kept) >= k else np.inf
                    limit = min(limit, threshold) if threshold is not None else limit
                    group = group[gap[group] <= limit * (1 + 1e-9) + 1e-12]
                    if not len(group):
                        break
                    c = cand[group]
                    count += len(c)
                    both = seen[c] * m
                    n = both.sum(axis=1)
                    d = (y - x[c]) * both
                    mean = np.divide(d.sum(axis=1), n, out=np.zeros(len(c)), where=n > 0)
                    te = np.sqrt(np.divide((((d - mean[:, None]) * both) ** 2).sum(axis=1), n - 1, out=np.full(len(c), np.nan), where=n > 1))
                    for j in np.flatnonzero((n >= max(least, 2)) & np.isfinite(te)):
                        t = round(float(te[j]), 9)
                        if threshold is None or t <= threshold:
                            kept.append((t, int(off[group[j]]), int(order_of[c[j]]), int(c[j])))
                    kept = sorted(kept)[: k + 1]
                kept = kept[:k]
                at_all = [(key, names[c], t, int((seen[c] * m).sum()), o, 0) for t, o, _, c in kept]
                rows += at_all + [(key, None, None, None, None, count)]
            if rows:
                cols = list(zip(*rows))
                fields = [b.schema.field(0).type, None, pa.float64(), pa.int32(), pa.int64(), pa.int64()]
                kind = pa.array(names).type if names else pa.null()
                fields[1] = kind
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(cols, fields)], names=[fund, index, "te", "n", "off", "candidates"])

    return run


def asset_to_model(univ: DataFrame, models: DataFrame, scores: DataFrame, key: str, market: str) -> DataFrame:
    """Model per asset: the first model that owns its market, else the best mapping score.

    ``models``: model, position, market. ``scores``: key, model, score of covering models.
    """
    own = univ.join(models, market).groupBy(key).agg(F.min_by("model", F.struct("position", "model")).alias("_own"))
    pos = models.select("model", "position").distinct()
    s = scores.join(pos, "model").groupBy(key).agg(F.max_by("model", F.struct(F.col("score"), -F.col("position"))).alias("_best"))
    return univ.join(own, key, "left").join(s, key, "left").withColumn("model", F.coalesce("_own", "_best")).drop("_own", "_best")


def merge_nodes(a: DataFrame, b: DataFrame, name: str, tags: tuple[str, str]) -> DataFrame:
    """Union of two hierarchies; names that occur in both get the model's tag."""
    u = a.withColumn("model", F.lit(tags[0])).unionByName(b.withColumn("model", F.lit(tags[1])))
    n = u.groupBy(name).agg(F.count_distinct("model").alias("_n"))
    return u.join(n, name).withColumn("node", F.when(F.col("_n") > 1, F.concat_ws("-", name, "model")).otherwise(F.col(name))).drop("_n")


def coverage(issues: DataFrame, rules: DataFrame, key: str, on: Sequence[str], exclusions: DataFrame | None = None) -> DataFrame:
    """Intervals in which each issue belongs to each model, touching ones merged.

    Exclusion intervals (key, model, from_dt, thru_dt) are cut out; several per issue are
    cut one after another by splitting at their ends.
    """
    c = overlap_join(issues, rules, on).select(key, "model", "from_dt", "thru_dt")
    c = merge_intervals(c, [key, "model"])
    if exclusions is None:
        return c
    x = merge_intervals(exclusions.select(key, "model", "from_dt", "thru_dt"), [key, "model"])
    return subtract_intervals(c, x, [key, "model"])


def subtract_intervals(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of the intervals of ``a`` that no interval of ``b`` covers.

    Both sides hold disjoint intervals per key. Ends become +1/-1 events per key and day,
    so a window holds at most one row per day.
    """
    keys = list(keys)

    def ends(df: DataFrame, on_a: int, on_b: int) -> DataFrame:
        end = lambda c, s: F.struct(F.col(c).alias("at"), F.lit(s * on_a).alias("_a"), F.lit(s * on_b).alias("_b"))
        return df.select(*keys, F.inline(F.array(end("from_dt", 1), end("thru_dt", -1))))

    ev = ends(a, 1, 0).unionByName(ends(b, 0, 1))
    ev = spread(ev.groupBy(*keys, "at").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")), keys)
    w = W.partitionBy(*keys).orderBy("at")
    run = w.rowsBetween(W.unboundedPreceding, 0)
    s = ev.select(*keys, F.col("at").alias("from_dt"), F.lead("at").over(w).alias("thru_dt"), F.sum("_a").over(run).alias("_a"), F.sum("_b").over(run).alias("_b"))
    return merge_intervals(s.where("_a > 0 and _b = 0 and thru_dt is not null").select(*keys, "from_dt", "thru_dt"), keys)


def model_universe(cover: DataFrame, home: DataFrame, key: str, model: str, on_date, nursery: Sequence = ()) -> DataFrame:
    """Issues of a model alive on a date with a nursery flag by home market."""
    d = F.lit(on_date).cast("date")
    live = cover.where((F.col("model") == model) & (F.col("from_dt") <= d) & (d < F.col("thru_dt")))
    return live.join(home.select(key, "home"), key, "left").withColumn("nursery", F.coalesce(F.col("home").isin(*nursery), F.lit(False)))


def anti_by_change(prev: DataFrame, curr: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows of ``curr`` that are new or differ from ``prev`` in any of ``cols``."""
    p = prev.select(*keys, F.struct(*cols).alias("_old"))
    j = curr.select(*keys, *cols).join(p, list(keys), "left")
    return j.where(F.col("_old").isNull() | ~F.struct(*cols).eqNullSafe(F.col("_old"))).drop("_old")


