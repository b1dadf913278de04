"""Code trees: closure, common ancestors, fusion of evidence, crosswalks, retrieval, name evidence."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.session import cut


def closure(tree: DataFrame, depth: int = 12) -> DataFrame:
    """(code, ancestor, distance) with every code its own ancestor at distance 0; ``tree`` is (code, parent).

    One equi-join per level; a cycle shows as a path longer than ``depth`` and is an error.
    """
    step = tree.select("code", "parent")
    paths = ring = cut(step.select("code", F.col("code").alias("ancestor"), F.lit(0).alias("distance")))
    for k in range(1, depth + 2):
        up = step.select(F.col("code").alias("ancestor"), "parent").filter("parent IS NOT NULL AND parent <> ''")
        ring = cut(ring.join(up, "ancestor").select("code", F.col("parent").alias("ancestor"), F.lit(k).alias("distance")))
        if ring.isEmpty():
            return paths
        if k > depth:
            raise ValueError("the tree has a cycle or is deeper than allowed")
        paths = paths.unionByName(ring)
    return paths


def tree_problems(tree: DataFrame) -> DataFrame:
    """(problem, code): codes that stand twice and parents that are no code."""
    twice = tree.groupBy("code").count().filter("count > 1").select(F.lit("duplicate").alias("problem"), "code")
    orphan = tree.filter("parent IS NOT NULL AND parent <> ''").join(tree.select(F.col("code").alias("parent")).distinct(), "parent", "left_anti").select(F.lit("unknown parent").alias("problem"), "code")
    return twice.unionByName(orphan)


def common_ancestor(sets: DataFrame, paths: DataFrame) -> DataFrame:
    """(id, lca) of the codes of each id: the deepest ancestor that all of them have; ``sets`` is (id, code)."""
    codes = sets.select("id", "code").distinct()
    need = codes.groupBy("id").agg(F.count(F.lit(1)).alias("need"))
    depth = paths.groupBy("code").agg(F.max("distance").alias("depth"))
    shared = codes.join(paths, "code").groupBy("id", "ancestor").agg(F.count(F.lit(1)).alias("have")).join(need, "id").filter("have = need")
    ranked = shared.join(depth.withColumnRenamed("code", "ancestor"), "ancestor").groupBy("id").agg(F.max(F.struct("depth", "ancestor")).alias("b"))
    return need.select("id").join(ranked, "id", "left").select("id", F.col("b.ancestor").alias("lca"))


def descendants(codes: DataFrame, paths: DataFrame, leaves_only: bool = False) -> DataFrame:
    """(code, descendant), optionally only codes without children."""
    down = codes.join(paths.select(F.col("ancestor").alias("code"), F.col("code").alias("descendant"), "distance"), "code")
    if leaves_only:
        inner = paths.filter("distance = 1").select(F.col("ancestor").alias("descendant")).distinct()
        down = down.join(inner, "descendant", "left_anti")
    return down.select("code", "descendant")


#: Codes of a tree that are sent to every task at most.
MAX_TREE = 200_000
#: Kinds of evidence that name no activity.
NO_ACTIVITY = ("NOT_ACTIVITY", "UNCODEABLE")


class CodeTree:
    """A code tree in memory, with subtrees as sets of codes."""

    def __init__(self, rows: list[tuple[str, str | None]]):
        self.parent = {c: p or None for c, p in rows}
        self.below: dict[str, set[str]] = {c: {c} for c in self.parent}
        self.line: dict[str, tuple[str, ...]] = {}
        for c in self.parent:
            line, at = [], c
            while at in self.parent and at not in line:
                line.append(at)
                self.below[at].add(c)
                at = self.parent[at]
            self.line[c] = tuple(reversed(line))

    def depth(self, code: str) -> int:
        return len(self.line[code])

    def ordered(self, codes) -> list[str]:
        return sorted(codes, key=lambda c: (len(self.line.get(c, ())), c))

    def subtree(self, codes) -> set[str]:
        """All codes at or below the given ones; unknown codes cover nothing."""
        return set().union(*(self.below[c] for c in codes if c in self.below))

    def roots(self, codes: set[str]) -> list[str]:
        """The codes of a set that have no code of the set above them."""
        return self.ordered(c for c in codes if c in self.line and not any(x in codes for x in self.line[c][:-1]))

    def common(self, codes) -> str | None:
        """The deepest code at or above all the given ones."""
        level = [same for same in zip(*(self.line[c] for c in codes)) if len(set(same)) == 1]
        return level[-1][0] if level else None


def _one_step_up(tree: CodeTree, groups: list[list[str]]) -> str | None:
    """The parent at which independent groups meet: every group names one code, the deepest codes are
    several children of one parent of depth two or more, and all other codes lie on the way to it."""
    if len(groups) < 2 or any(len(roots) != 1 for roots in groups):
        return None
    codes = {roots[0] for roots in groups}
    deepest = {c for c in codes if tree.depth(c) == max(map(tree.depth, codes))}
    parents = {tree.parent[c] for c in deepest}
    if len(deepest) < 2 or len(parents) != 1:
        return None
    parent = parents.pop()
    on_the_way = parent in tree.line and tree.depth(parent) >= 2 and codes - deepest <= set(tree.line[parent])
    return parent if on_the_way else None


def fused(tree: CodeTree, evidence: list[tuple[str, str, str, list[str]]]) -> dict:
    """Decision over the evidence (source, group, kind, codes) of one record, in the order of the evidence."""
    stated = [e for e in evidence if e[2] is not None and e[2] not in NO_ACTIVITY]
    idle = {e[1] for e in evidence if e[2] == "NOT_ACTIVITY"}
    out = {
        "code": None, "relation": "EMPTY", "flags": [], "candidates": [], "sources": list(dict.fromkeys(e[0] for e in stated)),
        "groups": len({e[1] for e in stated}), "activity_conflict": any(e[1] != g for e in stated for g in idle),
    }
    by_group: dict[str, list[list[str]]] = {}
    for _, group, _, codes in stated:
        by_group.setdefault(group, []).append(codes)
    agreed: list[list[str]] = []
    for group, lists in by_group.items():
        now: set[str] | None = None
        for codes in lists:
            covered = tree.subtree(codes)
            if not covered:
                continue
            if now is None:
                now = covered
            elif now & covered:
                now = now & covered
            else:
                # dependent sources that disagree leave both possible
                now = now | covered
                out["flags"].append(f"DEPENDENT_CONFLICT:{group}")
        if now is not None:
            agreed.append(tree.roots(now))
            out["candidates"] += [c for codes in lists for c in codes]
    out["candidates"] = tree.ordered(set(out["candidates"]))
    if not agreed:
        return out
    if (parent := _one_step_up(tree, agreed)) is not None:
        return out | {"code": parent, "relation": "INTERSECT", "flags": out["flags"] + ["INDEPENDENT_SIBLING_BACKOFF"]}
    meet = set.intersection(*(tree.subtree(roots) for roots in agreed))
    if not meet:
        return out | {"relation": "CONFLICT"}
    if (code := tree.common(tree.roots(meet))) is None:
        return out | {"relation": "UNION", "flags": out["flags"] + ["NO_COMMON_ANCESTOR"]}
    if len(stated) == 1:
        return out | {"code": code, "relation": "UNION" if stated[0][2] == "UNION" else "SINGLE"}
    shown = [c for e in stated if (r := tree.roots(set(e[3]))) and (c := tree.common(r)) is not None]
    shown.sort(key=tree.depth)
    chain = all(a in tree.line[b] for a, b in zip(shown, shown[1:]))
    varied = len({tree.depth(c) for c in shown}) > 1
    return out | {"code": code, "relation": "NESTED" if chain and varied else "INTERSECT"}


_FUSED = "code string, relation string, flags array<string>, candidates array<string>, sources array<string>, groups int, activity_conflict boolean"


def fuse(evidence: DataFrame, tree: DataFrame) -> DataFrame:
    """(id, code, relation, flags, candidates, sources, groups, activity_conflict) of evidence (id, source, grp, kind, codes).

    Codes stand for their subtrees.  Within a dependency group the subtrees of the sources intersect, or
    unite with a flag where they do not; across groups they intersect.  Independent groups that name
    children of one parent step back to it.  SINGLE and UNION for one statement, NESTED where the
    statements lie on one line at several depths, INTERSECT otherwise, CONFLICT without common code,
    EMPTY without a known code.  Statements of kind NOT_ACTIVITY and UNCODEABLE give no codes; a group
    that says not-activity against another that names a code is an activity conflict.  Evidence counts
    in the order of its sources; repeated rows count once.  The tree (code, parent) is sent to the tasks
    and may have ``MAX_TREE`` codes.
    """
    rows = tree.select("code", "parent").filter("code IS NOT NULL").distinct().limit(MAX_TREE + 1).collect()
    if len(rows) > MAX_TREE:
        raise ValueError(f"a tree of more than {MAX_TREE} codes")
    shipped = evidence.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])
    kind_of_id = dict(evidence.dtypes)["id"]
    item = F.struct("source", "grp", "kind", F.array_sort(F.array_distinct(F.coalesce("codes", F.array().cast("array<string>")))).alias("codes"))
    grouped = evidence.select("id", item.alias("e")).distinct().groupBy("id").agg(F.sort_array(F.collect_list("e")).alias("e"))

    def run(batches):
        import pyarrow as pa

        known = CodeTree(shipped.value)
        for batch in batches:
            found = [fused(known, [(e["source"], e["grp"], e["kind"], [c for c in e["codes"] if c is not None]) for e in items]) for items in batch.column(1).to_pylist()]
            texts = pa.list_(pa.string())
            kinds = {"code": pa.string(), "relation": pa.string(), "flags": texts, "candidates": texts, "sources": texts, "groups": pa.int32(), "activity_conflict": pa.bool_()}
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([f[n] for f in found], k) for n, k in kinds.items()]], names=["id", *kinds])

    return grouped.mapInArrow(run, f"id {kind_of_id}, {_FUSED}")


def crosswalk(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, target, status) of texts (id, key) under rules (kind, pattern, target): exact keys first,
    then contained keys; rules that disagree give AMBIGUOUS and no target, no rule gives NONE.

    Exact rules are an equi-join; contained rules are joined on their words, not on all pairs.
    """
    exact = texts.join(rules.filter("kind = 'exact'").select(F.col("pattern").alias("key"), "target"), "key").select("id", "target", F.lit(1).alias("level"))
    words = texts.select("id", "key", F.explode(F.array_distinct(F.split("key", " "))).alias("word"))
    part = rules.filter("kind = 'contains'").select("pattern", "target", F.split("pattern", " ")[0].alias("word"))
    inside = words.join(part, "word").filter(F.instr(F.concat(F.lit(" "), F.col("key"), F.lit(" ")), F.concat(F.lit(" "), F.col("pattern"), F.lit(" "))) > 0).select("id", "target", F.lit(2).alias("level"))
    hits = exact.unionByName(inside)
    first = hits.withColumn("top", F.min("level").over(W.partitionBy("id"))).filter("level = top")
    found = first.groupBy("id").agg(F.countDistinct("target").alias("n"), F.min("target").alias("target"))
    return texts.select("id").join(found, "id", "left").select("id", F.when(F.col("n") == 1, F.col("target")).alias("target"), F.when(F.col("n").isNull(), "NONE").when(F.col("n") == 1, "MATCH").otherwise("AMBIGUOUS").alias("status"))


def tf_idf(texts: DataFrame) -> DataFrame:
    """(id, term, w): L2-normalised weights (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1) over words of two
    letters or more and their pairs; ``texts`` is (id, texts, copies), ``copies`` the documents with these texts."""
    words = F.filter(F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}_]+", " "), " "), lambda w: F.length(w) >= 2)
    tokens = texts.select("id", "copies", F.explode("texts").alias("text")).select("id", "copies", words.alias("w"))
    pairs = F.when(F.size("w") > 1, F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1)))).otherwise(F.array().cast("array<string>"))
    counts = tokens.select("id", "copies", F.explode(F.concat("w", pairs)).alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("copies").alias("copies"))
    n = texts.agg(F.sum("copies")).first()[0] or 0
    df = counts.groupBy("term").agg(F.sum("copies").alias("df"))
    raw = counts.join(df, "term").select("id", "term", ((1 + F.log("tf")) * (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "id").select("id", "term", (F.col("w") / F.col("norm")).alias("w"))


#: Different texts of queries up to which their answers are sent to all tasks.
ANSWERS = 20_000


def retrieve(queries: DataFrame, targets: DataFrame, k: int, block: int = 5_000) -> DataFrame:
    """(query, target, score, rank) of the k most similar targets per query; ties to the smaller target.

    Both are (id, text); the weights are those of queries and targets together.  Equal texts are compared
    once: blocks of about ``block`` different texts of queries meet blocks of as many of targets, every pair of
    blocks once; a task holds one pair of blocks and hands on the k best targets of each query, so products
    never leave their task.  A text of targets stands for its smallest ids, of which k are enough.
    """

    def documents(side: DataFrame) -> DataFrame:
        some = side.filter("id IS NOT NULL").groupBy(F.col("id").cast("string").alias("id")).agg(F.array_sort(F.collect_list("text")).alias("texts"))
        return some.select("id", F.to_json("texts").alias("form"), "texts")

    asked, given = documents(queries), documents(targets)
    q_forms = cut(asked.groupBy("form").agg(F.first("texts").alias("texts"), F.count(F.lit(1)).alias("copies")))
    g_forms = cut(given.groupBy("form").agg(F.first("texts").alias("texts"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("target")))
    blocks = [max(1, math.ceil(side.count() / block)) for side in (q_forms, g_forms)]
    both = q_forms.select("form", "texts", "copies").unionByName(g_forms.select("form", "texts", "copies"))
    weights = cut(tf_idf(both.groupBy(F.col("form").alias("id")).agg(F.first("texts").alias("texts"), F.sum("copies").alias("copies"))))
    q = weights.join(q_forms.select(F.col("form").alias("id")), "id").select(F.col("id").alias("query"), "term", F.col("w").alias("wq"))
    g = weights.join(g_forms.select(F.col("form").alias("id"), "target"), "id").select("target", "term", F.col("w").alias("wt"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.select(F.pmod(F.xxhash64("query"), F.lit(blocks[0])).cast("int").alias("x"), spread(blocks[1]).alias("y"), "query", F.col("term").alias("word"), "wq")
    g = g.select(spread(blocks[0]).alias("x"), F.pmod(F.xxhash64("target"), F.lit(blocks[1])).cast("int").alias("y"), "target", F.col("term").alias("word"), "wt")

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names, owner = np.unique(right["target"].to_numpy(str), return_inverse=True)
        term, terms = pd.factorize(right["word"], sort=False)
        order = np.argsort(term, kind="stable")
        owner, weight = owner[order], right["wt"].to_numpy(float)[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
        at = pd.Index(terms).get_indexer(left["word"]) if len(terms) else np.full(len(left), -1)
        out = ([], [], [])
        for query, rows in left.groupby("query", sort=False).indices.items():
            hits = [(ends[i], ends[i + 1], w) for i, w in zip(at[rows], left["wq"].to_numpy(float)[rows]) if i >= 0]
            if not hits:
                continue
            score = np.round(np.bincount(np.concatenate([owner[a:b] for a, b, _ in hits]), np.concatenate([weight[a:b] * w for a, b, w in hits]), len(names)), 9)
            least = np.partition(score, -k)[-k] if len(score) > k else 0.0
            near = np.flatnonzero((score >= least) & (score > 0))
            for i in near[np.lexsort((near, -score[near]))][:k]:
                for column, v in zip(out, (query, str(names[i]), float(score[i]))):
                    column.append(v)
        return pd.DataFrame({"query": pd.Series(out[0], dtype=object), "target": pd.Series(out[1], dtype=object), "score": pd.Series(out[2], dtype=float)})

    dots = q.groupBy("x", "y").cogroup(g.groupBy("x", "y")).applyInPandas(best, "query string, target string, score double")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "target"))
    near = cut(dots.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank"))
    # the k smallest ids of every text that came near
    needed = near.select("target").distinct().join(g_forms.select("form", "target"), "target")
    ids = given.select("form", "id").join(F.broadcast(needed) if needed.limit(ANSWERS + 1).count() <= ANSWERS else needed.hint("shuffle_merge"), "form")
    ids = ids.withColumn("n", F.row_number().over(W.partitionBy("form").orderBy("id"))).filter(F.col("n") <= k).select("target", "id")
    answers = near.join(ids, "target").select("query", F.col("id").alias("target"), "score").withColumn("rank", rank).filter(F.col("rank") <= k)
    answers = cut(answers.groupBy(F.col("query").alias("form")).agg(F.collect_list(F.struct("target", "score", "rank")).alias("answers")))
    answers = F.broadcast(answers) if answers.limit(ANSWERS + 1).count() <= ANSWERS else answers.hint("shuffle_merge")
    found = asked.select(F.col("id").alias("query"), "form").join(answers, "form").select("query", F.explode("answers").alias("a"))
    return found.select("query", "a.target", "a.score", "a.rank")


def resolve_by_name(rows: DataFrame, min_support: int = 2) -> DataFrame:
    """(id, code, support) for rows (id, name, codes) with exactly two codes: the one code that all rows
    of the same name with a single code have, if at least ``min_support`` different ids say so."""
    single = rows.filter((F.size("codes") == 1) & (F.col("name") != "")).select("name", F.col("codes")[0].alias("code"), "id")
    evidence = single.groupBy("name").agg(F.countDistinct("code").alias("labels"), F.min("code").alias("code"), F.countDistinct("id").alias("support"))
    good = evidence.filter((F.col("labels") == 1) & (F.col("support") >= min_support))
    open_rows = rows.filter(F.size("codes") == 2)
    return open_rows.join(good, "name").filter(F.array_contains(F.col("codes"), F.col("code"))).select("id", "code", "support")


def majority(votes: DataFrame) -> DataFrame:
    """(id, code) that more than half of the votes (id, code) name."""
    counted = votes.groupBy("id", "code").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("all", F.sum("n").over(W.partitionBy("id"))).filter("2 * n > all").select("id", "code")


def level_report(tree: DataFrame, paths: DataFrame) -> DataFrame:
    """(level, codes, leaves) of a tree."""
    depth = paths.groupBy("code").agg(F.max("distance").alias("level"))
    inner = tree.filter("parent IS NOT NULL AND parent <> ''").select(F.col("parent").alias("code")).distinct().withColumn("inner", F.lit(1))
    return depth.join(inner, "code", "left").groupBy("level").agg(F.count(F.lit(1)).alias("codes"), F.sum(F.col("inner").isNull().cast("long")).alias("leaves"))


def subtree_sets(left: DataFrame, right: DataFrame, paths: DataFrame) -> DataFrame:
    """(id, code, relation) of the subtrees below the codes of two sides (id, code): both, left or right only."""
    a = left.join(paths.select(F.col("ancestor").alias("code"), F.col("code").alias("leaf")), "code").select("id", F.col("leaf").alias("code")).distinct()
    b = right.join(paths.select(F.col("ancestor").alias("code"), F.col("code").alias("leaf")), "code").select("id", F.col("leaf").alias("code")).distinct()
    both = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), ["id", "code"], "full_outer")
    return both.select("id", "code", F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), "both").when(F.col("a").isNotNull(), "left").otherwise("right").alias("relation"))


def automatic_mapping(ranked: DataFrame, least: float = 0.45, margin: float = 0.12) -> DataFrame:
    """(query, target, status) from a ranking (query, target, score, rank): the first target if its score
    and its lead over the second suffice; LOW or CLOSE otherwise."""
    best = ranked.groupBy("query").agg(F.max(F.when(F.col("rank") == 1, F.struct("score", "target"))).alias("f"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("second"))
    lead = F.col("f.score") - F.coalesce("second", F.lit(0.0))
    status = F.when(F.col("f.score") < least, "LOW").when(lead < margin, "CLOSE").otherwise("MAPPED")
    return best.select("query", F.when(status == "MAPPED", F.col("f.target")).alias("target"), status.alias("status"))


def nearest_bridge(codes: DataFrame, bridge: DataFrame, paths: DataFrame) -> DataFrame:
    """(code, via, target) by the nearest ancestor, the code itself first, that has a bridge row (code, target)."""
    up = codes.join(paths, "code").join(bridge.withColumnRenamed("code", "ancestor"), "ancestor")
    first = up.groupBy("code").agg(F.min(F.struct("distance", "ancestor", "target")).alias("b"))
    return codes.join(first, "code", "left").select("code", F.col("b.ancestor").alias("via"), F.col("b.target").alias("target"))


def map_union(sets: DataFrame, mapped: DataFrame) -> DataFrame:
    """(id, targets) of code sets (id, code): the sorted targets, null when any code has none."""
    joined = sets.join(mapped.select("code", "target"), "code", "left")
    return joined.groupBy("id").agg(F.when(F.bool_and(F.col("target").isNotNull()), F.array_join(F.array_sort(F.collect_set("target")), "; ")).alias("targets"))


def tag_rules(tags: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, code, status) of rows (id, tag) under rules (code, need, tag), need being all or any: a rule
    holds when all its ``all`` tags and one of its ``any`` tags are there; several codes conflict."""
    totals = rules.groupBy("code").agg(F.sum((F.col("need") == "all").cast("int")).alias("all_n"), F.sum((F.col("need") == "any").cast("int")).alias("any_n"))
    hits = tags.distinct().join(rules, "tag").groupBy("id", "code").agg(F.sum((F.col("need") == "all").cast("int")).alias("a"), F.sum((F.col("need") == "any").cast("int")).alias("b"))
    good = hits.join(totals, "code").filter("a = all_n AND (any_n = 0 OR b > 0)")
    found = good.groupBy("id").agg(F.countDistinct("code").alias("n"), F.min("code").alias("code"))
    return tags.select("id").distinct().join(found, "id", "left").select("id", F.when(F.col("n") == 1, F.col("code")).alias("code"), F.when(F.col("n").isNull(), "NONE").when(F.col("n") == 1, "RULE").otherwise("CONFLICT").alias("status"))


def level_guard(rows: DataFrame, fine_parents: DataFrame, middle_parents: DataFrame) -> DataFrame:
    """(id, fine, middle, coarse, status): codes of three levels made to nest.

    The finest code given wins; coarser ones are its ancestors, and a given coarser code that is not its
    ancestor is a CONFLICT that keeps what was given.  Parents are (code, parent).
    """
    a = fine_parents.select(F.col("code").alias("fine"), F.col("parent").alias("fine_up"))
    b = middle_parents.select(F.col("code").alias("m"), F.col("parent").alias("m_up"))
    joined = rows.join(a, "fine", "left")
    m = F.coalesce("fine_up", "middle")
    joined = joined.withColumn("m", m).join(b, "m", "left")
    c = F.coalesce("m_up", "coarse")
    clash = (F.col("fine_up").isNotNull() & F.col("middle").isNotNull() & (F.col("fine_up") != F.col("middle"))) | (F.col("m_up").isNotNull() & F.col("coarse").isNotNull() & (F.col("m_up") != F.col("coarse")))
    return joined.select("id", "fine", F.when(clash, F.col("middle")).otherwise(F.col("m")).alias("middle"), F.when(clash, F.col("coarse")).otherwise(c).alias("coarse"), F.when(clash, "CONFLICT").otherwise("OK").alias("status"))


def coverage(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, filled, total) of the columns that hold a nonblank value."""
    sums = rows.agg(F.count(F.lit(1)).alias("total"), *[F.sum((F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "").cast("long")).alias(f"c{i}") for i, c in enumerate(columns)])
    return sums.select("total", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("filled")) for i, c in enumerate(columns)])).alias("x")).select("x.column_name", "x.filled", "total")


def by_distinct_key(rows: DataFrame, keys: list[str], decide) -> DataFrame:
    """``rows`` with the columns that ``decide`` adds to their distinct keys: each key is decided once.

    Null keys are keys like others.
    """
    decided = decide(rows.select(*keys).distinct())
    added = [c for c in decided.columns if c not in keys]
    a, b = rows.alias("a"), decided.alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.join(b, same, "left").select("a.*", *[F.col(f"b.{c}") for c in added])


def hybrid(a, b, blocked):
    """(code, status) columns of two independent codes: AGREE, DISAGREE, FIRST, SECOND, BLOCKED or NONE."""
    code = F.when(blocked, F.lit(None)).when(a.isNotNull() & b.isNotNull() & (a != b), F.lit(None)).otherwise(F.coalesce(a, b))
    status = F.when(blocked, "BLOCKED").when(a.isNotNull() & b.isNotNull(), F.when(a == b, "AGREE").otherwise("DISAGREE")).when(a.isNotNull(), "FIRST").when(b.isNotNull(), "SECOND").otherwise("NONE")
    return code, status


def longest_rule(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, target, pattern) of texts (id, key) by the longest rule (pattern, target) that is the key or
    ends it after an underscore; ties by the pattern."""
    tails = texts.select("id", "key", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("key", "_"))), lambda n: F.array_join(F.slice(F.split("key", "_"), -n, n), "_"))).alias("pattern"))
    hits = tails.join(rules, "pattern").groupBy("id").agg(F.max(F.struct(F.length("pattern").alias("l"), "pattern", "target")).alias("b"))
    return texts.select("id").join(hits, "id", "left").select("id", F.col("b.target").alias("target"), F.col("b.pattern").alias("pattern"))
