"""Label, column and value of every table row in a note's text, in one narrow stage of higher-order functions.

A fold over the lines finds the headers (years, or labels that may go on over several lines); then
every line is read against the last header above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordfacts.functions.amounts import find_amounts, normalize_amount
from fjordfacts.functions.text import let, once, rstrip, strip

# Labels of stamps and running heads.
NO_LABELS = ("docusign", "envelope id", "noter til regnskapet")
_YEAR = r"20[0-2]\d"
_HEADERS = "array<struct<at:int,labels:array<string>,open:boolean>>"


def cells(line: Column) -> Column:
    return F.filter(F.transform(F.split(line, "\t"), strip), lambda c: c != "")


def is_label(c: Column) -> Column:
    return F.length(c).between(2, 60) & normalize_amount(c).isNull() & (F.regexp_count(c, F.lit(r"\d")) < F.length(c) * 0.4)


def trailing_years(line: Column) -> Column:
    """The years in the last cells of a line with tabs."""
    found = F.regexp_extract(F.regexp_replace(line, r"[ \u00a0]*\t[\s\u00a0]*", "\t"), rf"(?:^|\t)((?:{_YEAR}\t)*{_YEAR})\s*$", 1)
    return F.when(F.contains(line, F.lit("\t")) & (found != ""), F.split(found, "\t")).otherwise(F.array().cast("array<string>"))


def spaced_years(line: Column) -> Column:
    """The years of a line without tabs that says little else."""
    years = F.regexp_extract_all(line, F.lit(rf"(?U)\b({_YEAR})\b"), 1)
    rest = strip(F.regexp_replace(line, rf"(?U)\b{_YEAR}\b", ""))
    good = ~F.contains(line, F.lit("\t")) & (F.size(years) > 0) & ~rest.rlike(r"\d{3,}") & (F.length(rest) < 60)
    return F.when(good, years).otherwise(F.array().cast("array<string>"))


def _facts(line: Column) -> Column:
    def read(cs: Column) -> Column:
        return F.struct(line.alias("line"), cs.alias("cells"), F.transform(cs, lambda c: normalize_amount(c)).alias("values"), trailing_years(line).alias("tab_years"), spaced_years(line).alias("years"), (F.size(cs) > 0).alias("filled"), F.forall(cs, is_label).alias("labels"))

    return let(cells(line), read)


def headers(lines: Column) -> Column:
    """Array of (at, labels, open): every header with its line number from 0 and its column labels."""
    def step(state: Column, x: Column) -> Column:
        n, found = state["n"], state["found"]
        last = F.try_element_at(found, F.lit(-1))
        grows = x["filled"] & x["labels"] & F.coalesce(last["open"], F.lit(False))
        fits = F.size(x["cells"]) <= F.size(last["labels"]) + 1
        years = F.when(F.size(x["tab_years"]) > 0, x["tab_years"]).otherwise(x["years"])
        head = F.array(F.struct(n.alias("at"), years.alias("labels"), F.lit(False).alias("open")))
        field = F.array(F.struct(n.alias("at"), x["cells"].alias("labels"), F.lit(True).alias("open")))
        merged = F.transform(F.sequence(F.lit(0), F.greatest(F.size(last["labels"]), F.size(x["cells"])) - 1), lambda j: F.concat_ws(" ", F.get(last["labels"], j), F.get(x["cells"], j)))
        rest = F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0)))
        longer = F.concat(rest, F.array(F.struct(last["at"].alias("at"), merged.alias("labels"), F.lit(True).alias("open"))))
        closed = F.when(F.size(found) > 0, F.concat(rest, F.array(F.struct(last["at"].alias("at"), last["labels"].alias("labels"), F.lit(False).alias("open"))))).otherwise(found)
        now = F.when(~x["filled"], found).when(F.size(x["tab_years"]) > 0, F.concat(closed, head)).when(grows & fits, longer).when(F.size(x["years"]) > 0, F.concat(closed, head)).when((F.size(x["cells"]) >= 2) & x["labels"], F.concat(closed, field)).otherwise(closed)
        return F.struct((n + 1).alias("n"), now.cast(_HEADERS).alias("found"))

    start = F.struct(F.lit(0).alias("n"), F.array().cast(_HEADERS).alias("found"))
    return F.aggregate(lines, start, step, lambda s: s["found"])


def _good_label(label: Column) -> Column:
    return (F.length(label) >= 2) & ~label.rlike(r"^\d+$")


_CELL = "array<struct<label:string,col:string,value:double>>"


def _pairs(label: Column, labels: Column, values: Column) -> Column:
    n = F.least(F.size(labels), F.size(values))
    each = F.transform(F.slice(values, 1, n), lambda v, i: F.struct(label.alias("label"), F.get(labels, i).alias("col"), v.alias("value")))
    return each.cast(_CELL)


def _spaced(line: Column, body) -> Column:  # noqa: ANN001
    """body(label, values) of the amounts in running text and what stands before the first."""
    return let(find_amounts(line), lambda found: F.when(F.size(found) > 0, let(strip(F.substring(line, F.lit(1), F.get(found, F.lit(0))["start"])), lambda label: body(label, F.transform(found, lambda a: a["value"])))).otherwise(F.array().cast(_CELL)))


def _row(x: Column, labels: Column) -> Column:
    none = F.array().cast(_CELL)

    def table(run: Column) -> Column:
        head = F.array_join(F.slice(x["cells"], 1, F.greatest(F.size(x["cells"]) - run, F.lit(0))), " ")

        def named(label: Column) -> Column:
            allowed = _good_label(label) & ~F.exists(F.array(*map(F.lit, NO_LABELS)), lambda b: F.contains(F.lower(label), b))
            return F.when(allowed, _pairs(label, labels, F.slice(x["values"], F.size(x["values"]) - run + 1, run))).otherwise(none)

        return F.when(run > 0, let(head, named)).otherwise(none)

    # the trailing run of numbers: everything after the last cell that is none
    run = F.aggregate(x["values"], F.lit(0), lambda a, v: F.when(v.isNull(), 0).otherwise(a + 1))
    spaced = _spaced(strip(x["line"]), lambda label, values: F.when(_good_label(label), _pairs(label, labels, values)).otherwise(none))
    return F.when(F.size(x["cells"]) >= 2, let(run, table)).when(x["filled"], spaced).otherwise(none)


def _unkeyed(x: Column) -> Column:
    def first(label: Column, values: Column) -> Column:
        one = F.array(F.struct(label.alias("label"), F.lit("").alias("col"), F.get(values, F.lit(0)).alias("value"))).cast(_CELL)
        return F.when(F.length(label) >= 2, one).otherwise(F.array().cast(_CELL))

    return _spaced(strip(F.replace(x["line"], F.lit("\t"), F.lit(" "))), first)


def facts(notes: DataFrame, text: str = "raw_text", keep: tuple[str, ...] = ("doc_id", "nr")) -> DataFrame:
    """keep, line_idx, pos, label, col, value: one row for each value, repeated keys included. Text without a header gives the first amount of each line under col ''."""
    lines = F.transform(F.transform(F.split("_text", "\n"), rstrip), _facts)
    rows = once(notes.where(F.col(text).isNotNull()).select(*keep, F.col(text).alias("_text")), lines=lines).drop("_text")
    rows = once(rows, headers=headers(F.col("lines")))
    keyed = F.transform("lines", lambda x, i: F.aggregate(F.filter("headers", lambda h: h["at"] < i), F.lit(None).cast("array<string>"), lambda a, h: h["labels"]))
    rows = rows.withColumn("columns", keyed).select(*keep, "headers", F.posexplode(F.arrays_zip("lines", "columns")).alias("line_idx", "z"))
    is_header = F.exists("headers", lambda h: h["at"] == F.col("line_idx"))
    read = F.when(F.size("headers") == 0, _unkeyed(F.col("z.lines"))).when(is_header | F.col("z.columns").isNull(), F.array().cast(_CELL)).otherwise(_row(F.col("z.lines"), F.col("z.columns")))
    return rows.select(*keep, "line_idx", F.posexplode(read).alias("pos", "f")).select(*keep, "line_idx", "pos", "f.*")


def key_values(found: DataFrame, keep: tuple[str, ...] = ("doc_id", "nr")) -> DataFrame:
    """keep, amount_key, value: of a repeated key the last value counts."""
    key = F.when(F.col("col") == "", F.col("label")).otherwise(F.concat_ws(" ", "label", "col"))
    return found.groupBy(*keep, key.alias("amount_key")).agg(F.max_by("value", F.struct("line_idx", "pos")).alias("value"))
