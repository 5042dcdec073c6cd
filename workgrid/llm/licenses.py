"""Licence scan: ordered signature rules, keyword prefilter, containment suppression, in DataFrame functions only.

A text is looked at closely only if one pass of a cheap expression finds a
keyword. In such a text every line (or paragraph, where notices may be
wrapped) runs the rules whose keyword it holds; a rule gives the spans of its matches. Of nested spans only the first in rank
stays: higher priority, then the longer span, then the earlier rule. The
base detections are phrases of consecutive words over the whole text and are
never suppressed.

The rules are one constant array, so the plan is a projection: no shuffle,
nothing collected, and a text's cost is bounded by its own size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workgrid.llm.common import ASCII_LOWER, ASCII_UPPER
from workgrid.llm.license_rules import over_lines, rules

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Fixed phrases and labels of the base detections.
BASE = (
    (("gnu", "general", "public", "license"), "gpl"),
    (("apache", "license"), "apache"),
    (("cc", "by"), "cc-by"),
    (("mit", "license"), "mit"),
)
BASE_SCORE = 0.5


def keywords() -> list[str]:
    return sorted({r.keyword for r in rules()})


#: Keywords that stand in the prefilter of a whole text: what any rule or base phrase must contain.
_GATE = (
    r"(?i)licen[cs]e|(?<![a-z0-9])cc|gpl|bsd|wtfpl|creative|copyright|\(c\)|©|rights|redistribut|permission"
    r"|warrant|attribution|spdx|\.org/|\.net/|\.eu/|public[ \t_-]+domain"
)


_GATE_OVER_LINES = over_lines(_GATE)
#: Between paragraphs: lines with nothing but blanks and comment marks, which no match goes over.
#: Possessive, so that a run of any length is one loop and not one call per line.
_PARAGRAPH = r"\n(?:[ \t\r#*/;%!>|-]*+\n)++"
#: Items of a block of a running total: a fold copies its state at every step, so that state is kept short.
_STEP = 128


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(items: Column, value, combine) -> Column:
    """For every item the combined values (whole numbers from 0) of all items before it."""
    zero, none = F.lit(0), F.array().cast("array<int>")
    part = lambda b: F.slice(items, b * _STEP + 1, F.lit(_STEP))

    def listed(values: Column, start: Column, of) -> Column:
        state = F.struct(start.alias("at"), none.alias("out"))
        step = lambda s, x: F.struct(combine(s["at"], of(x)).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(values, state, step, lambda s: s["out"])

    blocks = F.sequence(zero, F.greatest(F.floor((F.size(items) - 1) / _STEP), zero).cast("int"))
    totals = F.transform(blocks, lambda b: F.aggregate(part(b), zero, lambda a, x: combine(a, value(x))))
    starts = listed(totals, zero, lambda t: t)
    return F.flatten(F.transform(starts, lambda start, b: listed(part(b), start, value)))


def _spans(line: Column, r: Column) -> Column:
    """Matches of rule ``r`` in ``line`` as structs of position and rank; positions are summed up from match to match."""
    both = F.struct(F.regexp_extract_all(line, r["pattern"], F.lit(0)).alias("found"), F.split(line, r["pattern"], -1).alias("pieces"))
    sizes = _let(both, lambda x: F.transform(
        x["found"], lambda m, i: F.struct(F.length(F.get(x["pieces"], i)).alias("skip"), F.length(m).alias("size"))))

    def span(begin: Column, size: Column) -> Column:
        return F.struct(
            (-r["priority"]).alias("priority"),
            (-size).alias("size"),
            r["number"].alias("number"),
            begin.alias("begin"),
            (begin + size).alias("end"),
            r["label"].alias("label"),
        )

    def placed(sizes: Column) -> Column:
        before = _running(sizes, lambda m: m["skip"] + m["size"], lambda a, b: a + b)
        return _let(before, lambda at: F.transform(sizes, lambda m, i: span(F.get(at, i) + m["skip"], m["size"])))

    return _let(sizes, placed)


def _kept(spans: Column) -> Column:
    """Spans that are not nested with one of a better rank."""
    nested = lambda a, b: ((a["begin"] <= b["begin"]) & (a["end"] >= b["end"])) | ((b["begin"] <= a["begin"]) & (b["end"] >= a["end"]))
    return F.filter(spans, lambda d: ~F.exists(spans, lambda e: (e < d) & nested(e, d)))


def _kept_by_place(spans: Column) -> Column:
    """As :func:`_kept`, comparing only spans that are tied by overlaps: in order of place, a span that begins where
    all before it have ended starts a new group."""
    placed = F.array_sort(F.transform(spans, lambda d: F.struct(d["begin"].alias("begin"), d["end"].alias("end"), d.alias("d"))))

    def groups(placed: Column) -> Column:
        reach = _running(placed, lambda x: x["end"], F.greatest)
        first = _let(reach, lambda far: F.transform(placed, lambda x, i: F.when(x["begin"] >= F.get(far, i), i)))

        def of(start: Column, end: Column) -> Column:
            own = F.transform(F.slice(placed, start + 1, end - start), lambda x: x["d"])
            return _let(own, lambda some: F.when(F.size(some) > 1, _kept(some)).otherwise(some))

        return _let(F.array_compact(first), lambda starts: F.flatten(
            F.transform(starts, lambda s, k: of(s, F.coalesce(F.get(starts, k + 1), F.size(placed))))))

    return _let(placed, groups)


def detections(low: Column, wrapped: bool = False) -> Column:
    """Surviving detections of a lower-cased text: array of (priority, label).

    Rules run on single lines, or (``wrapped``) on paragraphs, in which a match may go on over line ends.
    """
    table = F.array(
        *(
            F.struct(
                F.lit(r.number).alias("number"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
                F.lit(r.keyword).alias("keyword"), F.lit(over_lines(r.pattern) if wrapped else r.pattern).alias("pattern"),
            )
            for r in rules()
        )
    )
    known = F.array(*(F.lit(k) for k in keywords()))
    parts = F.split(low, _PARAGRAPH if wrapped else "\n", -1)
    lines = F.filter(parts, lambda x: x.rlike(_GATE_OVER_LINES if wrapped else _GATE))

    def of_line(line: Column) -> Column:
        present = F.filter(known, lambda k: line.contains(k))
        chosen = _let(present, lambda p: F.filter(table, lambda r: F.array_contains(p, r["keyword"])))
        spans = F.flatten(F.transform(chosen, lambda r: _spans(line, r)))
        return _let(spans, _kept_by_place)

    found = F.flatten(F.transform(lines, of_line))
    return F.transform(found, lambda d: F.struct((-d["priority"]).alias("priority"), d["label"].alias("label")))


def scan(docs: DataFrame, wrapped: bool = False) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``:
    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections``.

    * words are runs of non-ASCII characters, digits and letters after lower-casing A-Z; a null text is empty;
    * ``n_base``: places of the base phrases; ``first_word`` / ``last_word``: their smallest and
      largest first word (from 0), null without one;
    * labels are distinct, sorted and comma-joined, empty without one;
    * ``score``: the largest priority / 100 of the detections, at least 0.5 with a base phrase, else 0;
    * with ``wrapped`` a notice may go on over line ends (see :func:`detections`), else it stands in one line;
    * rows are independent (repeated rows, null ids); an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    low = F.translate(text, ASCII_UPPER, ASCII_LOWER)
    gated = docs.select(
        "doc_id",
        F.regexp_count(text, F.lit(_WORD_ANY_CASE)).cast("long").alias("n_words"),
        F.when(text.rlike(_GATE_OVER_LINES if wrapped else _GATE), low).alias("_low"),
    )
    words = gated.withColumn("_words", F.when(F.col("_low").isNotNull(), F.regexp_extract_all("_low", F.lit(WORD), F.lit(0))))

    def places(phrase: tuple[str, ...]) -> Column:
        at = lambda i: [F.get("_words", i + k) == w for k, w in enumerate(phrase)]

        def here(i: Column) -> Column:
            test = at(i)
            out = test[0]
            for t in test[1:]:
                out = out & t
            return out

        last = F.size("_words") - len(phrase)
        return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))

    hit = F.col("_low").isNotNull()
    marked = words.select(
        "doc_id", "n_words",
        F.when(hit, F.array(*(places(p) for p, _ in BASE))).alias("_base"),
        F.when(hit, detections(F.col("_low"), wrapped)).alias("_found"),
    )
    every = F.flatten("_base")
    base = F.array_sort(F.array_compact(F.array(*(F.when(F.size(F.get("_base", i)) > 0, F.lit(label)) for i, (_, label) in enumerate(BASE)))))
    label = F.array_sort(F.array_distinct(F.concat(base, F.transform("_found", lambda d: d["label"]))))
    best = F.coalesce(F.array_max(F.transform("_found", lambda d: d["priority"] / 100.0)), F.lit(0.0))
    return marked.select(
        "doc_id", "n_words",
        F.coalesce(F.size(every), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.coalesce(F.array_join(base, ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join(label, ","), F.lit("")).alias("labels"),
        F.greatest(best, F.when(F.size(every) > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))).alias("score"),
        F.coalesce(F.size("_found"), F.lit(0)).alias("n_detections"),
    )
