"""Secret scans: fixed rules, and character Markov models of random strings.

Rules (leftmost, not overlapping, per kind): an assignment to a secret's name, an access key,
a long hexadecimal run. The models add `markov` spans: two Markov chains over characters, one
of random strings and one of ordinary identifiers, are trained from labelled samples; a run
of 20 or more key characters is a secret if the log-likelihood ratio of the two exceeds
EVIDENCE. All of it is built-in SQL functions: no Python runs on the rows, nothing is
shuffled, and a span costs what its text costs.

The samples for a query come from the documents themselves: what the rules match is random,
every other run is ordinary. They are drawn by hash, about SAMPLE documents however many
there are; without samples both models are uniform and no span is added.

Cases: null text has no span. Null or repeated ids are rows like others. Positions are code
points from 0, the end exclusive. Other columns don't matter.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

RUN = r"[A-Za-z0-9+/_=-]"  # characters of keys
LETTERS = 66  # so many
LEAST_RUN = 20
EVIDENCE = 12.0  # nats; a random string is taken to be one run in 160,000
SAMPLE = 8192  # documents to train from
SMOOTH = 0.5  # added to the count of each character
BACK = 4.0  # weight of single characters' frequencies among a character's transitions
CODES = 128
BLOCK = 256
MARK = "<secret>"

SPANS = "array<struct<start:int,kind:int,end:int>>"


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, join: Callable[[Column, Column], Column] = operator.add) -> Column:
    """Sums, or other joins from 0 on, of the values before each place; ints in, ints out.

    In blocks, as every step of an aggregate copies what it has gathered.
    """
    def sums(xs: Column) -> Column:
        return F.aggregate(xs, F.array(F.lit(0)), lambda acc, x: F.concat(
            acc, F.array(join(F.element_at(acc, -1), x))))

    blocks = F.transform(F.sequence(F.lit(1), F.size(values), F.lit(BLOCK)),
                         lambda at: sums(F.slice(values, at, F.lit(BLOCK))))
    bases = sums(F.transform(blocks, lambda b: F.element_at(b, -1)))
    return F.flatten(F.zip_with(
        blocks, F.slice(bases, 1, F.size(blocks)),
        lambda b, base: F.transform(F.slice(b, F.lit(1), F.size(b) - 1),
                                    lambda v: join(v, base))))


def matches(text: Column, pattern: str) -> Column:
    """(start, text) of all matches: the parts between them and their own lengths, summed."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    starts = F.zip_with(
        running(F.zip_with(F.slice(between, F.lit(1), F.size(found)), found,
                           lambda b, m: F.length(b) + F.length(m))),
        F.slice(between, F.lit(1), F.size(found)), lambda s, b: s + F.length(b))
    return F.arrays_zip(starts.alias("start"), found.alias("match"))


def spans_of(text: Column, pattern: str, kind: str, keep) -> Column:
    """Spans of the matches that `keep` accepts; texts without a match cost one search."""
    number = F.lit(KINDS.index(kind))
    found = F.transform(
        F.filter(matches(text, pattern), lambda m: keep(m["match"])),
        lambda m: F.struct(m["start"].alias("start"), number.alias("kind"),
                           (m["start"] + F.length(m["match"])).alias("end")))
    return F.when(text.rlike(pattern), found.cast(SPANS)).otherwise(
        F.array().cast(SPANS))


def assigned(match: Column) -> Column:
    """The value of an assignment."""
    return F.regexp_extract(match, f"^{ASSIGN}$", 2)


def base_spans(text: Column) -> Column:
    return F.concat(
        spans_of(text, ASSIGN, "assign", lambda m: F.length(assigned(m)) >= LEAST_VALUE),
        spans_of(text, f"{ACCESS[:-1]}{{{LEAST_ACCESS - 4},}}", "access", lambda m: F.lit(True)),
        spans_of(text, f"{HEX[:-1]}{{{LEAST_HEX},}}", "hex", lambda m: F.lit(True)))


def transitions(run: Column) -> Column:
    """The code of each pair of neighbours in a run, the first after a start (code 0).

    The run is split into characters once, so that the cost is in proportion to its length.
    """
    return named(
        F.transform(F.split(run, ""), lambda c: F.ascii(c)),
        lambda codes: F.zip_with(
            F.concat(F.array(F.lit(0)), F.slice(codes, F.lit(1), F.size(codes) - 1)), codes,
            lambda before, code: before * CODES + code))


def train(samples: DataFrame) -> DataFrame:
    """code, r, o: how often random and ordinary samples have each transition.

    `samples` has run, random (boolean) and n, how often it was seen.
    """
    seen = samples.select("random", "n", F.explode(transitions(F.col("run"))).alias("code"))
    return seen.groupBy("code").agg(
        F.sum(F.when(F.col("random"), F.col("n")).otherwise(0)).alias("r"),
        F.sum(F.when(F.col("random"), 0).otherwise(F.col("n"))).alias("o"))


def ratios(samples: DataFrame) -> list[float]:
    """The model: log of random over ordinary probability of each transition."""
    rows = train(samples).collect()  # at most CODES * CODES rows
    seen = {r["code"]: (float(r["r"]), float(r["o"])) for r in rows if r["code"] < CODES ** 2}

    def chain(which: int) -> list[float]:
        """Log probabilities; a rare character before leaves it to the frequencies of all."""
        after, before = [0.0] * CODES, [0.0] * CODES
        for code, n in seen.items():
            after[code % CODES] += n[which]
            before[code // CODES] += n[which]
        total = sum(after) + SMOOTH * LETTERS
        alone = [(x + SMOOTH) / total for x in after]
        return [math.log((seen.get(a * CODES + b, (0.0, 0.0))[which] + BACK * alone[b])
                         / (before[a] + BACK)) for a in range(CODES) for b in range(CODES)]

    return [x - y for x, y in zip(chain(0), chain(1))]


def evidence(run: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a run: random against ordinary."""
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in model)), ",").cast("array<double>")
    return F.aggregate(transitions(run), F.lit(0.0),
                       lambda acc, code: acc + F.element_at(table, code + 1))


def labelled(documents: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """run, random, n from about `sample` documents: what the rules match, and the rest."""
    total = documents.count()
    share = max(1, total // sample)
    some = documents.select(F.coalesce(F.col(text), F.lit("")).alias("text")).where(
        F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    values = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
                 lambda v: F.length(v) >= LEAST_RUN),
        F.regexp_extract_all("text", F.lit(f"{ACCESS[:-1]}{{{LEAST_ACCESS - 4},}}"), F.lit(0)),
        F.regexp_extract_all("text", F.lit(f"{HEX[:-1]}{{{LEAST_HEX},}}"), F.lit(0)))
    rest = F.col("text")
    for rule in (ASSIGN, f"{ACCESS[:-1]}{{{LEAST_ACCESS - 4},}}", f"{HEX[:-1]}{{{LEAST_HEX},}}"):
        rest = F.regexp_replace(rest, rule, " ")
    return some.select(F.explode(F.concat(
        F.transform(values, lambda v: F.struct(v.alias("run"), F.lit(True).alias("random"))),
        F.transform(F.regexp_extract_all(rest, F.lit(f"{RUN}+"), F.lit(0)),
                    lambda v: F.struct(v.alias("run"), F.lit(False).alias("random"))),
    )).alias("x")).groupBy("x.run", "x.random").agg(F.count("*").alias("n"))


def all_spans(text: Column, model: list[float]) -> Column:
    """Spans of the rules and of the models, by start, then kind."""
    return F.array_sort(F.concat(
        base_spans(text),
        spans_of(text, f"{RUN}{{{LEAST_RUN},}}", "markov",
                 lambda m: evidence(m, model) > EVIDENCE)))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def find_secrets(documents: DataFrame, model: list[float], key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id and spans (start, kind, end) of every document."""
    return documents.select(
        F.col(key).alias("doc_id"),
        all_spans(F.coalesce(F.col(text), F.lit("")), model).alias("spans"))


def part(blocks: Column, start: Column, end: Column) -> Column:
    """Code points start to end of a text that is given in blocks of BLOCK."""
    return F.when(start >= end, F.lit("")).otherwise(F.array_join(F.transform(
        F.sequence(F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")),
        lambda i: F.substring(
            F.element_at(blocks, i + 1), F.greatest(start - i * BLOCK, F.lit(0)) + 1,
            F.least(end, (i + 1) * BLOCK) - F.greatest(start, i * BLOCK))), ""))


def redact(text: Column, spans: Column, mark: str = MARK) -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark.

    The text is cut into blocks once and every part between marks is taken from its own
    blocks: a span does not cost the text before it.
    """
    whole = F.struct(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"),
        F.length(text).alias("length"),
        F.array_max(F.transform(spans, lambda s: s["end"])).alias("last"),
        F.filter(F.zip_with(
            running(F.transform(spans, lambda s: s["end"]), F.greatest), spans,
            lambda at, s: F.struct(at.alias("at"), s["start"].alias("to"))),
            lambda gap: gap["at"] <= gap["to"]).alias("gaps"))
    return F.when(F.size(spans) == 0, text).otherwise(named(whole, lambda w: F.concat(
        F.array_join(F.transform(w["gaps"], lambda gap: F.concat(
            part(w["blocks"], gap["at"], gap["to"]), F.lit(mark))), ""),
        part(w["blocks"], w["last"], w["length"]))))


def redact_documents(documents: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """The documents, all columns as they were, with secrets replaced by a mark.

    A column n_chars, where there is one, is set anew for texts that change.
    """
    def fresh(name: str) -> str:
        while name in documents.columns:
            name += "_"
        return name

    spans, clean = fresh("__secret_spans"), fresh("__clean_text")
    out = documents.withColumn(spans, all_spans(F.coalesce(F.col(text), F.lit("")), model))
    out = out.withColumn(clean, redact(F.col(text), F.col(spans)))

    def column(name: str) -> Column:
        if name == text:
            return F.col(clean).alias(text)
        if name == "n_chars":
            kind = documents.schema[name].dataType
            return F.when(F.size(spans) == 0, F.col(name)).otherwise(
                F.length(clean).cast(kind)).alias(name)
        return F.col(f"`{name}`")

    return out.select([column(name) for name in documents.columns])
