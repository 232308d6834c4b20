"""Quality rules as weak votes, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.mixing import SPACE, WORD
from sluice.llm.voting import VoteModel, fit, histogram
from sluice.session import materialize

WINDOW = 5
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_alnum", "n_marks", "n_distinct", "n_same"]


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds a struct ``stats`` (:data:`STATS`, all long) computed inside the row from the whole text; a null text is empty.

    Repeated windows: each run of five words is hashed to 64 bits. Only where a hash occurs twice are the (hash, place) pairs
    sorted, neighbours compared and the covered words counted, as the sum of steps between repeated windows, at most five each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    width = F.lit(WINDOW)

    def count(pattern: str, of: Column = text) -> Column:
        return F.regexp_count(of, F.lit(pattern)).cast("long")

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    cut = df.withColumn("__words", F.filter(F.split(text, SPACE + "+", -1), lambda w: w != "")).withColumn("__lines", lines)
    words, n = F.col("__words"), F.size("__words")

    def at(i: Column, step: int) -> Column:
        return F.get(words, i + step)

    starts = F.slice(words, F.lit(1), F.greatest(n - width + 1, F.lit(0)))
    hashed = cut.withColumn("__hashes", F.transform(starts, lambda w, i: F.xxhash64(w, *[at(i, s) for s in range(1, WINDOW)])))
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    pairs = F.when(repeats, F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    same_next = F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i + 1), F.lit(False))))
    sorted_ = hashed.withColumn("__pairs", pairs).withColumn("__same", same_next).withColumn("__distinct", F.size(F.array_distinct(F.transform(words, F.lower))))
    same = lambda i, j: F.get("__pairs", i)["h"] == F.get("__pairs", j)["h"]
    twice = F.filter("__pairs", lambda p, k: F.coalesce(same(k, k + 1), F.lit(False)) | ((k > 0) & F.coalesce(same(k, k - 1), F.lit(False))))
    placed = sorted_.withColumn("__places", F.sort_array(F.transform(twice, lambda p: p["i"])))
    steps = F.transform("__places", lambda p, k: F.least(F.coalesce(F.get("__places", k + 1) - p, width), width))
    covered = F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda acc, s: acc + s), F.lit(0).cast("long"))
    stats = F.struct(
        n.cast("long").alias("n_words"),
        (F.char_length(text) - count(SPACE)).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        count(r"\p{Lu}").alias("n_upper"),
        count(r"[\p{L}\p{N}]").alias("n_alnum"),
        count(r"[!?]").alias("n_marks"),
        F.col("__distinct").cast("long").alias("n_distinct"),
        F.col("__same").cast("long").alias("n_same"),
    )
    return placed.withColumn("stats", stats).drop("__words", "__lines", "__hashes", "__pairs", "__distinct", "__same", "__places")


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 10) | (F.lit(100) * stats["n_repeat_words"] > F.lit(20) * stats["n_words"])


def _vote(value: Column, good_to: float, bad_from: float) -> Column:
    """Yes up to ``good_to``, no from ``bad_from``; between them, and where the value is unknown, the rule abstains."""
    return F.when(value <= good_to, 1).when(value >= bad_from, 0)


def rule_votes(stats: Column) -> dict[str, Column]:
    """Each rule looks at one statistic; short texts make most of them abstain."""
    words, letters = stats["n_words"], stats["n_alnum"]
    share = lambda part, whole: F.when(whole > 0, part / whole)
    enough = lambda value: F.when(words >= 20, value)
    repeated = F.greatest(share(stats["n_repeat_words"], words),
                          F.when(stats["n_lines"] >= 4, share(stats["n_dup_lines"], stats["n_lines"])))
    shouted = F.greatest(share(stats["n_upper"], letters), F.lit(2) * share(stats["n_marks"], words))
    return {
        "symbols": _vote(share(stats["n_symbols"], words), 0.02, 0.15),
        "letters": _vote(F.lit(1.0) - share(letters, stats["word_chars"]), 0.07, 0.10),
        "shouting": enough(_vote(shouted, 0.12, 0.30)),
        "repeats": enough(_vote(repeated, 0.05, 0.15)),
        "stutter": F.when(words >= 10, _vote(share(stats["n_same"], words), 0.05, 0.20)),
        "variety": F.when(words >= 50, _vote(F.lit(1.0) - share(stats["n_distinct"], F.least(words, F.lit(300))), 0.55, 0.75)),
    }


#: Believed accuracies before any data: a yes vote on good text, a no vote on bad text. Bad text breaks some rules, not all.
BELIEFS = {"symbols": (0.98, 0.40), "letters": (0.96, 0.50), "shouting": (0.99, 0.30), "repeats": (0.98, 0.40), "stutter": (0.99, 0.20), "variety": (0.97, 0.30)}


def vote_quality(df: DataFrame, text_col: str = "text", drop_text: bool = False, prior: float = 0.85,
                 label: str = "quality-votes") -> tuple[DataFrame, VoteModel]:
    """Adds ``stats``, ``base_failed``, ``posterior`` and ``kept``; also returns the model.

    Rules vote yes or no on a row's statistics or abstain. Expectation-maximisation over the histogram of all rows' votes
    estimates how far each rule can be trusted on good and on bad text; the posterior probability of good text decides, in place
    of a demand that all rules pass. ``kept`` is false where the base rule fails, else the posterior is 0.5 or more.

    Statistics are computed once and written to the shared folder, with the rows (``drop_text`` leaves the text out), since the
    model needs all votes before the first row can be judged. Null and empty texts have no words, so the base rule fails.
    Repeated rows count as often as they occur; an empty table keeps the believed accuracies.
    """
    counted = with_statistics(df, text_col)
    written = materialize(counted.drop(text_col) if drop_text else counted, label)
    votes = rule_votes(F.col("stats"))
    names = list(votes)
    model = fit(histogram(written.select([votes[v].alias(v) for v in names]), names), names, BELIEFS, prior)
    failed = F.coalesce(base_failed(F.col("stats")), F.lit(True))
    posterior = model.posterior(votes)
    judged = (written.withColumn("base_failed", failed).withColumn("posterior", posterior)
              .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)))
    return judged, model


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that :func:`vote_quality` keeps, with their own columns only."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("__text"))
    judged, _ = vote_quality(rows, "__text", drop_text=True)
    return judged.where("kept").select("doc.*")
