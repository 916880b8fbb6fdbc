"""Quality rules per document, failure rates per host, and host verdicts back on documents.

Column expressions and joins only. A rule's failure rate at a host is shrunk towards the rate over all hosts with
a beta prior whose strength comes from how much the hosts' rates spread (method of moments): a host with three
documents says little, one with three million speaks for itself. A document goes if it fails a base rule, or if it
fails one of the other rules at a host where that rule's shrunk rate is high. Clean documents of bad hosts stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .text import shielded, unshielded

MIN_WORDS = 20
#: Largest share of words in repeated windows, in percent.
MAX_REPEAT = 30
WINDOW = 8
#: Host rules: name, and when a document fails it.
RULES = {
    "symbols": "20 * n_symbols > word_chars",
    "repeats": "100 * n_repeat_words > 10 * n_words",
    "lines": "10 * n_dup_lines > n_words",
    "lengths": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
#: A rule counts against the documents that fail it where its shrunk rate at the host is above this.
MAX_RATE = 0.3
#: Copies of a host's statistics, so that one host's rows meet them in as many tasks.
SALTS = 32


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed.

    A null text counts as empty. Window equality is judged on 64-bit hashes of the words' hashes.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    got = docs.withColumns({"_w": F.filter(F.split(body, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""), "_l": F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))})
    got = got.withColumns({"n_words": F.size("_w").cast("long"), "_h": F.transform("_w", lambda w: F.xxhash64(w))})
    windows = F.expr(f"case when n_words >= {WINDOW} then transform(sequence(1, cast(n_words as int) - {WINDOW - 1}), i -> xxhash64(slice(_h, i, {WINDOW}))) else cast(array() as array<bigint>) end")
    got = got.withColumn("_v", windows)
    # Windows sorted with their places: those with an equal neighbour are repeated, and the words they
    # cover follow from the gap to the repeated window before. Texts without any skip the sort.
    pairs = F.expr("array_sort(transform(_v, (h, i) -> struct(h, i)))")
    got = got.withColumn("_p", F.when(F.size(F.array_distinct("_v")) == F.size("_v"), F.expr("cast(array() as array<struct<h: bigint, i: int>>)")).otherwise(pairs))
    places = F.expr("""array_sort(transform(filter(
        transform(_p, (x, k) -> struct(x.i as i, (k > 0 and element_at(_p, if(k > 0, k, 1)).h = x.h) or (k < size(_p) - 1 and element_at(_p, if(k < size(_p) - 1, k + 2, 1)).h = x.h) as twice)),
        x -> x.twice), x -> x.i))""")
    got = got.withColumn("_r", places)
    covered = F.expr(f"aggregate(transform(_r, (x, k) -> if(k = 0, {WINDOW}, least({WINDOW}, x - element_at(_r, if(k > 0, k, 1))))), 0L, (s, x) -> s + x)")
    got = got.withColumns({
        "word_chars": F.char_length(F.translate(body, " \t\n\x0b\f\r", "")).cast("long"),
        "n_symbols": (F.char_length(body) - F.char_length(F.translate(body, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": covered,
    }).drop("_w", "_l", "_h", "_v", "_p", "_r")
    return got.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words"))


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: documents, and each rule's failure rate shrunk by an empirical beta prior.

    A null host is a host of its own. With m the mean and v the variance of the hosts' rates (hosts weigh alike),
    the prior has strength m (1 - m) / v - 1, kept within 1 and 1000; without spread it is 1000.
    """
    fails = [F.sum(F.expr(f"cast({how} as long)")).alias(f"f_{name}") for name, how in RULES.items()]
    # Staged: a row per host, read for the prior and again for the join; the documents are read once.
    hosts = staged(measured.groupBy(F.col(host).alias("_host")).agg(F.count(F.lit(1)).alias("host_docs"), *fails))
    moments = hosts.agg(*[x for name in RULES for x in (F.avg(F.expr(f"f_{name} / host_docs")).alias(f"m_{name}"), F.var_pop(F.expr(f"f_{name} / host_docs")).alias(f"v_{name}"))])
    prior = moments.first()  # one row of two numbers per rule
    out = []
    for name in RULES:
        m, v = prior[f"m_{name}"] or 0.0, prior[f"v_{name}"] or 0.0
        strength = min(1000.0, max(1.0, m * (1 - m) / v - 1)) if v > 1e-9 else 1000.0
        out.append(((F.col(f"f_{name}") + F.lit(strength * m)) / (F.col("host_docs") + F.lit(strength))).alias(f"rate_{name}"))
    return hosts.select("_host", "host_docs", *out)


def judged(measured: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """``measured`` plus kept, by its own measures and its host's rates. The join is salted: no host's rows meet in one task."""
    salted = hosts.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    # Any salt gives the same row. This one also keeps filters on the verdict above the measures: pushed below, they would spell them out many times over.
    salt = (F.monotonically_increasing_id() % SALTS).cast("int")
    failed: Column = F.lit(False)
    for name, how in RULES.items():
        failed = failed | (F.expr(how) & (F.col(f"rate_{name}") > MAX_RATE))
    rows = measured.withColumn("_mine", salt)
    on = F.col(host).eqNullSafe(F.col("_host")) & (F.col("_mine") == F.col("_salt"))
    return rows.join(salted, on, "left").withColumn("kept", ~F.col("base_failed") & ~F.coalesce(failed, F.lit(False))).drop("_mine", "_salt", "_host")


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judge(docs: DataFrame, text: str = "text", host: str = "source", keep_text: bool = True) -> DataFrame:
    """``docs`` with its measures, its host's rates and kept; nothing is dropped here, but the text if it isn't asked for.

    The measures are taken once and written: hosts are counted, and documents judged, from there. Columns of ``docs`` that are called like those made here are replaced.
    """
    inner, at = shielded(docs)
    measured = measures(inner, at[text])
    measured = staged(measured if keep_text else measured.drop(at[text]))
    out = judged(measured, host_rates(measured, at[host]), at[host])
    left = {old: new for old, new in at.items() if keep_text or old != text}
    return unshielded(out, left, [*MEASURES, "host_docs", *[f"rate_{name}" for name in RULES], "kept"])
