"""Quality rules whose cutoffs are chosen with a bound on false rejections, by DataFrame functions alone.

For every stratum cutoffs are tried from the loosest to the tightest on labelled good texts that passed the base rules:
once for all rules together, level by level, and once for each rule. A level is taken while the exact binomial bound
allows: were more than the test's share of good texts rejected, so few rejected ones among the labelled would have a
probability of at most the test's part of ``delta`` (Bonferroni over strata and tests); the first level that fails ends its row of
tests (fixed sequence), which needs no correction. Half of ``risk`` and ``delta`` goes to all rules together, the other
half is divided among the rules; a rule's cutoff is the tighter of both. So with a confidence of 1 - ``delta`` no
stratum has more than ``risk`` of its good texts rejected.

Defined cases: a null text has no words and fails the base rules. A stratum without enough good labels keeps all that
passes the base rules; a null stratum is one of its own. Repeated labels of an id count once, as good only if all are; labels without a
text count nothing. Rows that repeat an id are judged each. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inplay.llm.common import stored

_BLANK = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"
#: Rules: the measure and its cutoffs, from loose to tight. A text is rejected if the measure is over the cutoff.
RULES = {
    "symbols": ("n_symbols / n_words", [2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02]),
    "shouts": ("n_shouts / n_words", [2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1]),
    "capitals": ("n_capitals / word_chars", [0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15]),
    "wordless": ("n_wordless / n_words", [0.9, 0.7, 0.5, 0.4, 0.3, 0.2]),
    "repeated_lines": ("n_dup_lines / n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    "long_words": ("word_chars / n_words", [30.0, 20.0, 15.0, 12.0, 10.0, 9.0]),
    "short_words": ("n_words / word_chars", [0.9, 0.7, 0.5, 0.4, 0.3]),
}


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", window: int = 8) -> DataFrame:
    """(id, stratum, counts): counts of words, their code points, symbols, repeated lines, words in repeated windows and more."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("null")).alias("stratum"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", _BLANK), lambda w: w != ""))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.translate(x, _BLANKS, "") != ""))
    rows = rows.withColumn("hash", F.transform("words", lambda w: F.xxhash64(w)))
    # Each step hashes pairs of runs; a run of eight is a run of four and the run of four behind it.
    length = 1
    while length < window:
        step = min(length, window - length)
        rows = rows.withColumn("hash", joined(step))
        length += step
    # Only texts in which some window occurs twice are looked at further.
    rows = rows.withColumn("sorted", F.when(
        F.size(F.array_distinct("hash")) < F.size("hash"), F.sort_array(F.transform("hash", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    rows = rows.withColumn("places", F.sort_array(F.transform(
        F.filter(F.transform("sorted", lambda e, j: F.when(F.get("sorted", j - 1)["x"].eqNullSafe(e["x"]) | F.get("sorted", j + 1)["x"].eqNullSafe(e["x"]), e["i"])), lambda i: i.isNotNull()), lambda i: i)))
    covered = F.aggregate(F.transform("places", lambda p, k: F.least(F.lit(window), F.coalesce(F.get("places", k + 1) - p, F.lit(window)))),
                          F.lit(0), lambda a, b: a + b)
    symbols, shouts = "#*$%&|<>", "!?"
    size: dict[str, Column] = {
        "n_words": F.size("words"),
        "word_chars": F.char_length(F.translate("text", _BLANKS, "")),
        "n_symbols": F.char_length("text") - F.char_length(F.translate("text", symbols, "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("lines"),
        "n_shouts": F.char_length("text") - F.char_length(F.translate("text", shouts, "")),
        "n_capitals": F.char_length("text") - F.char_length(F.regexp_replace("text", r"\p{Lu}+", "")),
        "n_wordless": F.size(F.filter("words", lambda w: ~w.rlike(r"\p{L}"))),
    }
    return rows.select("id", "stratum", *(c.cast("long").alias(n) for n, c in size.items()))


def joined(step: int) -> Column:
    """Each hash of ``hash`` joined with the one ``step`` places on, as far as there is one."""
    return F.transform(F.slice("hash", F.lit(1), F.greatest(F.size("hash") - step, F.lit(0))), lambda x, i: F.xxhash64(x, F.get("hash", i + step)))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def few_enough(rejected: Column, good: Column, share: float, level: Column) -> Column:
    """Whether at most ``rejected`` of ``good`` texts has a binomial probability of at most ``level`` at ``share``; exact, in logarithms."""
    odds = F.log(F.lit(share / (1 - share)))
    none = good * F.log(F.lit(1 - share))
    start = F.struct(none.alias("term"), none.alias("total"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log(good - i + 1) - F.log(i) + odds
        top = F.greatest(acc["total"], term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(acc["total"] - top) + F.exp(term - top))).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1).cast("long"), rejected), start, step)["total"]
    # Above the mean the probability is over a half at least for sure; the sum there would only be long.
    return F.when(rejected >= good * share, F.lit(False)).when(rejected == 0, none <= F.log(level)).otherwise(total <= F.log(level))


def cutoffs(found: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """(stratum, one column for each rule): the tightest cutoff that the labels allow, null where they allow none."""
    good = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("good"))
    known = found.where(~base_failed()).join(good, "id").where("good = 1")
    tests = {name: [f"{measure} > {c}D" for c in cuts] for name, (measure, cuts) in RULES.items()}
    levels = max(map(len, tests.values()))
    # A rule with fewer cutoffs stays at its last.
    tests["all"] = [" OR ".join(f"({t[min(k, len(t) - 1)]})" for t in tests.values()) for k in range(levels)]
    tries = [(name, k, test) for name, rows in tests.items() for k, test in enumerate(rows)]
    counts = known.groupBy("stratum").agg(F.count("*").alias("n"), *(F.count_if(F.expr(test)).alias(f"{name}:{k}") for name, k, test in tries))
    rows = counts.select("stratum", "n", F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(k).alias("k"), F.col(f"`{name}:{k}`").alias("rejected")) for name, k, _ in tries))).alias("t"))
    # One row with the number of strata.
    rows = rows.select("stratum", "n", "t.*").join(F.broadcast(counts.agg(F.count("*").alias("strata"))), F.lit(True))
    parts = {name: 0.5 if name == "all" else 0.5 / len(RULES) for name in tests}
    ok = F.coalesce(*(F.when(F.col("rule") == name, few_enough(F.col("rejected"), F.col("n"), risk * part, F.lit(delta * part) / F.col("strata"))) for name, part in parts.items()))
    # How many levels hold before the first that does not.
    held = rows.withColumn("ok", ok).groupBy("stratum").pivot("rule", list(tests)).agg(F.coalesce(F.min(F.when(~F.col("ok"), F.col("k"))), F.lit(levels)))

    def cutoff(name: str) -> Column:
        cuts = RULES[name][1]
        own = F.get(F.array(*map(F.lit, cuts)), F.least(F.col(name), F.lit(len(cuts))) - 1)
        joint = F.get(F.array(*(F.lit(cuts[min(k, len(cuts) - 1)]) for k in range(levels))), F.col("all") - 1)
        return F.least(own, joint).alias(name)

    return held.select("stratum", *map(cutoff, RULES))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
           label_col: str = "quality", risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """(id, counts, base_failed, kept) of every row."""
    found = stored(features(docs, id_col, text_col, stratum_col), "features")
    cuts = stored(cutoffs(found, labels, id_col, label_col, risk, delta), "cutoffs")
    over = [F.coalesce(F.expr(f"{measure} > `{name}`"), F.lit(False)) for name, (measure, _) in RULES.items()]
    rejected = over[0]
    for o in over[1:]:
        rejected = rejected | o
    out = found.withColumn("base_failed", base_failed()).join(cuts, "stratum", "left")
    # A text that passed the base rules has words, so nothing is divided by zero.
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(~rejected)
    return out.select(F.col("id").alias(id_col), *(c for c in found.columns if c not in ("id", "stratum")), "base_failed", kept.alias("kept"))


def oracle(risk: float = 0.05, delta: float = 0.05) -> str:
    """SQL for the judged ``documents``: windows as texts, and binomial sums by the logarithms of factorials."""
    levels = max(len(cuts) for _, cuts in RULES.values())
    tests = {name: [f"{measure} > {c}" for c in cuts] for name, (measure, cuts) in RULES.items()}
    joint = [" OR ".join(f"{t[min(k, len(t) - 1)]}" for t in tests.values()) for k in range(levels)]
    tries = [(name, k, test) for name, rows in {**tests, "all": joint}.items() for k, test in enumerate(rows)]
    half = 0.5 / len(RULES)
    own = {name: f"CASE WHEN held['{name}'] > 0 THEN {cuts}[least(held['{name}'], {len(cuts)})] END" for name, (_, cuts) in RULES.items()}
    both = {name: f"CASE WHEN held['all'] > 0 THEN {cuts}[least(held['all'], {len(cuts)})] END" for name, (_, cuts) in RULES.items()}
    over = " OR ".join(f"coalesce({measure} > {name}, false)" for name, (measure, _) in RULES.items())
    word = r"[^\x20\x09-\x0D]"
    return f"""
    WITH listed AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}+') AS words,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM documents),
    windows AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w FROM listed, unnest(range(1, len(words) - 6)) t(i)),
    again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT r, count(DISTINCT j) AS n FROM again, unnest(range(i, i + 8)) t(j) GROUP BY r),
    found AS (SELECT l.*, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
      len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines, length(text) - length(translate(text, '!?', '')) AS n_shouts,
      length(text) - length(regexp_replace(text, '\\p{{Lu}}+', '', 'g')) AS n_capitals, len(list_filter(words, lambda x: NOT regexp_matches(x, '\\p{{L}}'))) AS n_wordless
      FROM listed l LEFT JOIN covered c USING (r)),
    based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM found),
    good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
    counts AS (SELECT lang, count(*) AS n, [{', '.join(f"count(*) FILTER (WHERE {t})" for *_, t in tries)}] AS rejected FROM based JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY lang),
    tried AS (SELECT lang, n, [{', '.join(f"'{name}'" for name, *_ in tries)}][i] AS rule, [{', '.join(str(k) for _, k, _ in tries)}][i] AS k, rejected[i] AS x,
      CASE WHEN i > {len(tries) - levels} THEN 0.5e0 ELSE {half!r} END AS part, (SELECT count(*) FROM counts) AS strata FROM counts, unnest(range(1, {len(tries) + 1})) t(i)),
    tested AS (SELECT lang, rule, k, x < n * {risk} * part AND list_sum(list_transform(range(0, x + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln({risk} * part) + (n - i) * ln(1 - {risk} * part)))) <= {delta} * part / strata AS ok FROM tried),
    held AS (SELECT lang, map_from_entries(list((rule, h))) AS held FROM (SELECT lang, rule, coalesce(min(k) FILTER (WHERE NOT ok), {levels}) AS h FROM tested GROUP BY ALL) GROUP BY lang),
    cuts AS (SELECT lang AS stratum, {', '.join(f"list_min([{own[name]}, {both[name]}]) AS {name}" for name in RULES)} FROM held)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT ({over}) AS kept
    FROM based LEFT JOIN cuts ON stratum IS NOT DISTINCT FROM lang"""
