"""Schema drift between the files of a run (problem 4).

1. Every top-level field and every member of the metadata object becomes a row
   (run, file, field, type, value); the structural index takes the texts apart.
2. Each (run, file, field) is profiled by built-in aggregates: fill, types, a theta sketch of
   its values and one of their shapes, length, share of digits, numeric quantiles. Sketches merge map-side, so a run
   that holds a third of all rows costs no more per task than any other.
3. Consecutive files of a run are compared. Fields only in the old and fields only in the new
   file are the two sides of a weighted bipartite graph; the maximum-weight matching above
   a threshold is the set of renames.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fjordfacts.operators import structural as S
from fjordfacts.session import cut, measured_broadcast

#: Members that hold the nested lists; they are problem 3's.
NESTED = ("manifest", "noter", "validation", "extraction_meta")
META = "extraction_meta"
#: True renames of the test runs score 0.62 to 0.95, chance pairs below 0.15.
RENAME_AT = 0.4


def members(df: DataFrame, run: str = "run_tag", seq: str = "file_seq", json_col: str = "payload", keep: str | None = None) -> DataFrame:
    """(run, seq, field, kind, value), and the column `keep` as `id` if given, for each direct member of the record and of its metadata object.

    kind is null for JSON null. Malformed texts and texts whose root is no object give no rows.
    """
    schema = f"run {df.schema[run].dataType.simpleString()}, seq {df.schema[seq].dataType.simpleString()}, field string, kind string, value string"
    if keep:
        schema = f"id {df.schema[keep].dataType.simpleString()}, {schema}"

    def run_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            index = S.build([t.encode("utf-8", "replace") for t in pdf["text"]])
            ok = np.flatnonzero(index.roots >= 0)
            ok = ok[index.kind[index.roots[ok]] == S.OPEN_OBJECT]
            at, child = index.children(index.roots[ok])
            row, prefix = ok[at], np.full(len(at), "", object)
            meta = index.keys_equal(child, META)
            inner_at, inner = index.children(child[meta])
            is_object = index.kind[child[meta]][inner_at] == S.OPEN_OBJECT
            drop = np.zeros(len(child), bool)
            for name in NESTED:
                drop |= index.keys_equal(child, name)
            nodes = np.concatenate((child[~drop], inner[is_object]))
            rows = np.concatenate((row[~drop], row[meta][inner_at][is_object]))
            prefix = np.concatenate((prefix[~drop], np.full(int(is_object.sum()), META + ".", object)))
            names, values, kinds = [], [], []
            for n, p in zip(nodes, prefix, strict=True):
                names.append(p + index.key(n))
                values.append(index.value_text(n))
                kinds.append(S.type_of(int(index.kind[n]), b"" if index.kind[n] in (S.QUOTE, S.OPEN_OBJECT, S.OPEN_ARRAY) else index.raw(n)))
            # a string holding JSON metadata text is opened as well
            texts = [(i, index.value_text(n)) for i, n in zip(row[meta], child[meta], strict=True) if index.kind[n] == S.QUOTE]
            if texts:
                sub = S.build([(t or "").encode() for _, t in texts])
                good = np.flatnonzero(sub.roots >= 0)
                sat, schild = sub.children(sub.roots[good])
                for g, n in zip(sat, schild, strict=True):
                    if sub.key_to[n]:
                        names.append(f"{META}.{sub.key(n)}")
                        values.append(sub.value_text(n))
                        kinds.append(S.type_of(int(sub.kind[n]), b"" if sub.kind[n] in (S.QUOTE, S.OPEN_OBJECT, S.OPEN_ARRAY) else sub.raw(n)))
                        rows = np.append(rows, texts[good[g]][0])
            ids = {"id": pdf["id"].to_numpy()[rows]} if keep else {}
            yield pd.DataFrame({**ids, "run": pdf["run"].to_numpy()[rows], "seq": pdf["seq"].to_numpy()[rows], "field": names, "kind": kinds, "value": values})

    ids = [df[keep].alias("id")] if keep else []
    rows = df.select(*ids, df[run].alias("run"), df[seq].alias("seq"), df[json_col].alias("text")).where("run is not null and seq is not null and text is not null")
    return rows.mapInPandas(run_batches, schema)


def profiles(rows: DataFrame) -> DataFrame:
    """One row for each (run, seq, field); all aggregates combine map-side and keep a bounded state."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", r"[0-9a-f]{12,}", "#"), r"\d+", "9"), r"\p{L}+", "a")
    number = F.expr("try_cast(value as double)")
    some = F.col("kind").isNotNull()
    return rows.groupBy("run", "seq", "field").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("kind").alias("n_filled"),
        *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("string", "number", "boolean", "array", "object")),
        F.avg(F.when(some, F.length("value"))).alias("mean_length"),
        F.avg(F.when(some, F.regexp_count("value", F.lit(r"\d")) / F.greatest(F.lit(1), F.length("value")))).alias("digit_share"),
        F.expr("percentile_approx(try_cast(value as double), array(0.1, 0.25, 0.5, 0.75, 0.9), 200)").alias("quantiles"),
        F.avg(F.when(some, number.isNotNull().cast("int"))).alias("numeric_share"),
        F.expr("theta_sketch_agg(case when kind is not null then value end, 12)").alias("values_sketch"),
        F.theta_sketch_agg(F.when(some, shape), 10).alias("shapes_sketch"),
    )


def _jaccard(a: str, b: str) -> F.Column:
    both = F.expr(f"theta_sketch_estimate(theta_intersection({a}, {b}))")
    either = F.expr(f"theta_sketch_estimate(theta_union({a}, {b}))")
    return F.when(either > 0, both / either).otherwise(0.0)


def _name_words(name: str) -> list[str]:
    return re.findall(r"[^\W_]+", name.rpartition(".")[2].lower())


def name_similarity(a: str, b: str) -> float:
    """Shared words, words that abbreviate another as a subsequence with the same first letter, shared trigrams."""
    if a.rpartition(".")[2] == b.rpartition(".")[2]:
        return 1.0
    x, y = _name_words(a), _name_words(b)
    if not x or not y:
        return 0.0

    def abbreviates(s: str, t: str) -> bool:
        if s[0] != t[0]:
            return False
        rest = iter(t)
        return all(c in rest for c in s)

    def best(w: str, others: list[str]) -> float:
        return max(1.0 if w == o else 0.8 if abbreviates(w, o) or abbreviates(o, w) else 0.0 for o in others)

    words = (sum(best(w, y) for w in x) + sum(best(w, x) for w in y)) / (len(x) + len(y))
    grams = [{s[i : i + 3] for i in range(len(s) - 2)} for s in ("  " + " ".join(x), "  " + " ".join(y))]
    shared = len(grams[0] & grams[1]) / max(1, len(grams[0] | grams[1]))
    return max(words, shared)


def match(weights: np.ndarray) -> list[tuple[int, int]]:
    """Maximum-weight bipartite matching; pairs of weight 0 stay unmatched. Shortest augmenting paths with potentials."""
    n, m = weights.shape
    size = max(n, m)
    cost = np.zeros((size + 1, size + 1))
    cost[1 : n + 1, 1 : m + 1] = -weights
    u, v, mate = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1, int)
    for i in range(1, size + 1):
        mate[0], j0 = i, 0
        least, used, way = np.full(size + 1, np.inf), np.zeros(size + 1, bool), np.zeros(size + 1, int)
        while True:
            used[j0] = True
            now = cost[mate[j0]] - u[mate[j0]] - v
            better = ~used & (now < least)
            least[better], way[better] = now[better], j0
            least_free = np.where(used, np.inf, least)
            least_free[0] = np.inf
            j1 = int(np.argmin(least_free))
            delta = least_free[j1]
            u[mate[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if mate[j0] == 0:
                break
        while j0:
            mate[j0] = mate[way[j0]]
            j0 = way[j0]
    return [(mate[j] - 1, j - 1) for j in range(1, m + 1) if 0 < mate[j] <= n and weights[mate[j] - 1, j - 1] > 0]


_KINDS = ("string", "number", "boolean", "array", "object")


def _pairs(profile: DataFrame) -> DataFrame:
    """Old-only against new-only fields of consecutive files with the sketch overlaps; the product is bounded by the number of fields that vanish and appear in one file."""
    order = Window.partitionBy("run").orderBy("seq")
    files = profile.select("run", "seq").distinct().withColumn("before", F.lag("seq").over(order)).where("before is not null")
    new = profile.join(files, ["run", "seq"])
    old = profile.withColumnRenamed("seq", "before").join(files, ["run", "before"])
    gone = old.join(new.select("run", "seq", "field"), ["run", "seq", "field"], "left_anti")
    come = new.join(old.select("run", "seq", "field"), ["run", "seq", "field"], "left_anti")
    keep = [c for c in profile.columns if c not in ("run", "seq")]
    left = gone.select("run", "seq", *(F.col(c).alias(f"{c}_old") for c in keep))
    right = come.select("run", "seq", *(F.col(c).alias(f"{c}_new") for c in keep))
    drop = [f"{s}_sketch_{w}" for s in ("values", "shapes") for w in ("old", "new")]
    out = left.join(right, ["run", "seq"]).withColumns({
        "same_values": _jaccard("values_sketch_old", "values_sketch_new"),
        "same_shapes": _jaccard("shapes_sketch_old", "shapes_sketch_new"),
        "distinct_old": F.expr("theta_sketch_estimate(values_sketch_old)"),
        "distinct_new": F.expr("theta_sketch_estimate(values_sketch_new)"),
    }).drop(*drop)
    return out


def content_similarity(p: dict) -> float:
    """How alike the contents of two profiled fields are, in [0, 1]."""
    old, new = (np.array([p[f"n_{k}_{w}"] for k in _KINDS], float) for w in ("old", "new"))
    if not old.sum() or not new.sum():
        return 0.0
    types = float(np.minimum(old / old.sum(), new / new.sum()).sum())
    few = min(p["distinct_old"], p["distinct_new"]) < 0.5 * min(p["n_filled_old"], p["n_filled_new"])
    length = float(np.exp(-abs(np.log((p["mean_length_old"] + 1) / (p["mean_length_new"] + 1))) * 3))
    digits = 1 - abs((p["digit_share_old"] or 0) - (p["digit_share_new"] or 0))
    numbers = 0.5
    a, b = p["quantiles_old"], p["quantiles_new"]
    if a is not None and b is not None and len(a) and len(b) and min(p["numeric_share_old"], p["numeric_share_new"]) > 0.8:
        a, b = np.array(a, float), np.array(b, float)
        spread = max(a[-1], b[-1]) - min(a[0], b[0])
        numbers = 1 - float(np.abs(a - b).mean() / spread) if spread > 0 else 1.0
        content = 0.7 * numbers + 0.3 * p["same_values"] if few else numbers
        return types * (0.8 * content + 0.2 * length)
    shapes = p["same_shapes"]
    if few:
        return types * (0.6 * p["same_values"] + 0.3 * shapes + 0.1 * length)
    return types * (0.65 * shapes + 0.15 * length + 0.2 * digits)


def score(p: dict) -> float:
    return 0.72 * content_similarity(p) + 0.28 * name_similarity(p["field_old"], p["field_new"])


def renames(profile: DataFrame, threshold: float = RENAME_AT) -> DataFrame:
    """(run, seq, field_old, field_new, score): the best matching of vanished to appeared fields of each file."""
    schema = "run string, seq int, field_old string, field_new string, score double"

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        old, new = sorted(set(pdf["field_old"])), sorted(set(pdf["field_new"]))
        weights = np.zeros((len(old), len(new)))
        for p in pdf.to_dict("records"):
            s = score(p)
            weights[old.index(p["field_old"]), new.index(p["field_new"])] = s if s >= threshold else 0.0
        found = match(weights)
        run, seq = str(pdf["run"].iloc[0]), int(pdf["seq"].iloc[0])
        return pd.DataFrame([(run, seq, old[i], new[j], float(weights[i, j])) for i, j in found], columns=["run", "seq", "field_old", "field_new", "score"])

    return _pairs(profile).groupBy("run", "seq").applyInPandas(best, schema)


def changes(profile: DataFrame, threshold: float = RENAME_AT) -> DataFrame:
    """(run_tag, file_seq, change, field_old, field_new) against the preceding file of the same run."""
    order = Window.partitionBy("run").orderBy("seq")
    files = profile.select("run", "seq").distinct().withColumn("before", F.lag("seq").over(order)).where("before is not null")
    most = F.greatest(*(F.col(f"n_{k}") for k in _KINDS))
    kind = F.coalesce(*(F.when((most > 0) & (F.col(f"n_{k}") == most), k) for k in _KINDS))
    slim = profile.select("run", "seq", "field", kind.alias("type"))
    new = slim.join(files, ["run", "seq"]).withColumnRenamed("type", "type_new")
    old = slim.withColumnRenamed("seq", "before").join(files, ["run", "before"]).select("run", "seq", "field", F.col("type").alias("type_old"), F.lit(True).alias("was"))
    both = old.join(new.withColumn("now", F.lit(True)).drop("before"), ["run", "seq", "field"], "full_outer")
    renamed = renames(profile, threshold)
    taken = renamed.select("run", "seq", F.explode(F.array(F.struct(F.col("field_old").alias("field"), F.lit("removed").alias("change")), F.struct(F.col("field_new").alias("field"), F.lit("added").alias("change")))).alias("x")).select("run", "seq", "x.*")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("type_old") != F.col("type_new"), "type_changed")
    plain = both.withColumn("change", change).where("change is not null").join(taken, ["run", "seq", "field", "change"], "left_anti")
    plain = plain.select("run", "seq", "change", F.when(F.col("change") == "added", "").otherwise(F.col("field")).alias("field_old"), F.when(F.col("change") == "removed", "").otherwise(F.col("field")).alias("field_new"))
    out = plain.unionByName(renamed.select("run", "seq", F.lit("renamed").alias("change"), "field_old", "field_new"))
    return out.withColumnsRenamed({"run": "run_tag", "seq": "file_seq"})


def unified(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(id, run_tag, file_seq, fields, clashes): one row for each record, its non-null fields as a JSON object under their unified names and types.

    `rows` are `members` with an id, and should be cut. A renamed field carries its name to later files until it is removed or
    renamed again; the names of one run are few, so they travel to the rows and not the rows to them. A field that has one type in
    all files keeps it; one of several types is a string in all. Where two fields of a record come to one name, the one that
    bears it counts, else the greatest value; the names this happened to with differing values are the clashes.
    """
    moves = F.array_sort(F.collect_list(F.struct("file_seq", "field", "unified", "until")))
    spans = cut(unified_names(found).groupBy("run_tag").agg(moves.alias("moves")).withColumnRenamed("run_tag", "run"))
    joined = rows.where("kind is not null").join(measured_broadcast(spans, 64 + 96 * F.size("moves")), "run", "left")
    hits = F.filter("moves", lambda m: (m["field"] == F.col("field")) & (m["file_seq"] <= F.col("seq")) & (F.col("seq") < m["until"]))
    name = F.coalesce(F.try_element_at(F.transform(hits, lambda m: m["unified"]), F.lit(-1)), F.col("field"))
    named = joined.select("id", "run", "seq", (name == F.col("field")).alias("own"), "kind", "value", name.alias("field")).distinct()
    types = cut(named.groupBy("run", "field").agg(F.when(F.min("kind") == F.max("kind"), F.min("kind")).otherwise("string").alias("type")))
    best = F.max(F.struct("own", "value", "kind")).alias("b")
    one = named.groupBy("id", "run", "seq", "field").agg(best, (F.count_distinct("value") > 1).alias("clash")).join(measured_broadcast(types, 96), ["run", "field"])
    quoted = F.to_json(F.create_map("field", F.col("b.value")))
    plain = F.concat(F.regexp_replace(F.to_json(F.create_map("field", F.lit(""))), '""\\}$', ""), F.col("b.value"), F.lit("}"))
    entry = F.when(F.col("type") == "string", quoted).otherwise(plain)
    inner = F.array_sort(F.collect_list(F.struct("field", F.substring(entry, F.lit(2), F.length(entry) - 2).alias("e"))))
    fields = F.concat(F.lit("{"), F.array_join(F.transform(inner, lambda x: x["e"]), ","), F.lit("}"))
    out = one.groupBy("id", "run", "seq").agg(fields.alias("fields"), F.array_sort(F.collect_list(F.when(F.col("clash"), F.col("field")))).alias("clashes"))
    return out.withColumnsRenamed({"run": "run_tag", "seq": "file_seq"})


def unified_names(found: DataFrame) -> DataFrame:
    """(run_tag, field, unified, file_seq, until): in which files of a run a later name stands for the first one.

    The changes of one run are bounded by its files and fields, not by its records.
    """
    schema = "run_tag string, field string, unified string, file_seq int, until int"

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        active: dict[str, tuple[str, int]] = {}
        out = []

        def close(name: str, seq: int) -> None:
            if name in active:
                unified, since = active.pop(name)
                out.append((run, name, unified, since, seq))

        run = str(pdf["run_tag"].iloc[0])
        for seq, group in pdf.sort_values("file_seq").groupby("file_seq"):
            moved = {}
            for p in group.to_dict("records"):
                if p["change"] == "renamed":
                    moved[p["field_new"]] = active.get(p["field_old"], (p["field_old"], 0))[0]
                if p["change"] in ("renamed", "removed"):
                    close(p["field_old"], int(seq))
            active.update({k: (v, int(seq)) for k, v in moved.items() if k != v})
        for name in list(active):
            close(name, 2**31 - 1)
        return pd.DataFrame(out, columns=["run_tag", "field", "unified", "file_seq", "until"])

    return found.where("change in ('renamed', 'removed')").groupBy("run_tag").applyInPandas(follow, schema)
