"""Personal data: labelling functions vote on candidate spans, with DataFrame functions only.

Offsets come from the pieces that ``split`` leaves between the matches of ``regexp_extract_all``. Patterns start at the place
where the plain left-to-right search would start and are possessive, so their time is linear in the text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.voting import fit
from sluice.session import materialize

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "A-Za-z0-9._%+-"
#: A match begins at the start of its run of characters, or where the previous match ended inside the run: any later start in
#: the same run would meet the same rest.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A chain of digits is matched whole by the base pattern, so chains of fewer than 13 need not be listed to be dropped.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
#: What a text must contain before the pattern is tried at all.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}

#: Candidates beyond the base: written-out addresses, local telephone numbers, IP versions with ports are base already.
WIDER = {
    "email": r"(?i)\b[a-z0-9._%+-]{2,40} ?[\[(] ?at ?[\])] ?[a-z0-9-]{2,40}(?: ?[\[(] ?dot ?[\])] ?[a-z0-9-]{2,20}){1,4}",
    "phone": r"(?<![0-9+.(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}

#: Gazetteers and context words (fixed values).
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "int", "info", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "us", "ch", "at")
NEAR = {
    "email": "e-?mail|mail|contact|write|correo|courriel|kontakt|address",
    "ip": r"\bip\b|host|server|address|login|client|addr",
    "card": r"card|visa|master|credit|payment|account|tarjeta|carte|karte|konto",
    "phone": r"phone|tel\b|tel\.|call|fax|mobile|contact|telefon|teléfono|téléphone",
}
AGAINST = r"(?i)(?:version|section|release|chapter|isbn|order|invoice|license|token|sha|hash|id)[^\p{L}\p{N}]{0,4}$"
ABOUT = 40  # characters of context before a span


def _spans(text: Column, pattern: str, need: str | None) -> Column:
    """Array of (start, match) in code points."""
    maybe = text.contains(need) if need else text.rlike("[0-9]")
    return F.when(maybe, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _placed(text: Column, pattern: str, matches: Column) -> Column:
    """Starts of the matches: lengths of the pieces before them and of the matches before them."""
    pieces = F.split(text, pattern, -1)
    zipped = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda piece, match: F.struct(
        F.char_length(piece).alias("gap"), F.char_length(match).alias("size"), match.alias("match")))
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")
    state = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["size"]).alias("end"), x["match"].alias("match"))
        return F.struct((start + x["size"]).alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    return F.when(F.size(matches) > 0, F.aggregate(zipped, state, step, lambda acc: acc["found"]))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """Every second digit from the right is doubled, less 9 where that is above 9; the sum is a multiple of 10."""
    digits = F.reverse(F.split(_digits(match), ""))
    worth = F.transform(F.filter(digits, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(worth, F.lit(0), lambda acc, d: acc + d) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(_OCTETS)
    if kind == "card":
        return F.char_length(_digits(match)).between(13, 19) & _luhn(match)
    if kind == "phone":
        return F.char_length(_digits(match)).between(9, 15)
    return F.lit(True)


LABELERS = ("pattern", "gazetteer", "context", "shape")


def _votes(kind: str, span: Column, text: Column, valid: Column) -> dict[str, Column]:
    """Votes of the labelers on one candidate; null abstains.

    ``pattern``: the base rule. ``gazetteer``: known domains, issuer prefixes, special address ranges. ``context``: words just
    before the span, or a letter that touches it. ``shape``: length and grouping usual for the kind.
    """
    match, start = span["match"], span["start"]
    ahead = F.substring(text, F.greatest(start - ABOUT, F.lit(0)) + 1, F.least(start, F.lit(ABOUT)))
    behind = F.substring(text, span["end"] + 1, 1)
    touches = ahead.rlike(r"[\p{L}\p{N}_]$") | behind.rlike(r"^[\p{L}\p{N}_]")
    context = F.when(ahead.rlike(AGAINST) | touches, 0).when(ahead.rlike(f"(?i)(?:{NEAR[kind]})"), 1)
    digits = _digits(match)
    if kind == "email":
        known = "|".join(TOP_DOMAINS)
        gazetteer = F.when(match.rlike(rf"(?i)[.\])\x20](?:{known})$"), 1)
        shape = F.when(F.char_length(match).between(6, 80), 1).otherwise(0)
        context = F.when(ahead.rlike(f"(?i)(?:{NEAR[kind]})"), 1)
    elif kind == "ip":
        gazetteer = F.when(match.rlike(r"^(?:0|00|000)\."), 0).when(match.rlike(r"^(?:10|127|172|192)\."), 1)
        shape = F.when(match.rlike(r"(?:^|\.)0[0-9]"), 0).otherwise(1)
    elif kind == "card":
        gazetteer = F.when(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"), 1)
        shape = F.when(match.rlike(r"^(?:[0-9]{16}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5})$"), 1
                       ).when(F.char_length(digits) > 19, 0)
    else:
        gazetteer = F.when(match.rlike(r"^\+(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"), 1)
        shape = F.when(F.char_length(digits).between(10, 13) & match.rlike(r"[\x20().-]"), 1).when(F.char_length(digits) < 9, 0)
    return {"pattern": F.when(valid, 1).otherwise(F.lit(None) if kind == "card" else F.lit(0)) if kind in BASE else F.lit(None),
            "gazetteer": gazetteer, "context": context, "shape": shape}


def with_candidates(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``candidates``: array of (kind, start, end, base, pattern, gazetteer, context, shape). A null text has none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found, sources = df, []
    for kind in KINDS:
        for name, pattern in (("base", BASE[kind]), ("wider", WIDER.get(kind))):
            if pattern:
                need = {"base": _NEEDS.get(kind)}.get(name) if name == "base" else ("at" if kind == "email" else None)
                found = found.withColumn(f"__{name}_{kind}", _spans(text, pattern, need))
                sources.append((name, kind, pattern))
    for name, kind, pattern in sources:
        column = f"__{name}_{kind}"
        found = found.withColumn(column, _placed(text, pattern, F.col(column)))

    def described(name: str, kind: str) -> Column:
        def one(span: Column) -> Column:
            valid = _valid(kind, span["match"]) if name == "base" else F.lit(False)
            votes = _votes(kind, span, text, valid)
            if name == "wider":
                votes["pattern"] = F.lit(None)
            return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                            valid.alias("base"), *[votes[v].cast("int").alias(v) for v in LABELERS])

        spans = F.coalesce(F.col(f"__{name}_{kind}"), F.array().cast("array<struct<start:int,end:int,match:string>>"))
        listed = F.transform(spans, one)
        if name == "wider":  # what the base has found already is no new candidate
            taken = F.col(f"__base_{kind}")
            listed = F.filter(listed, lambda c: ~F.coalesce(F.exists(taken, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])), F.lit(False)))
        return listed

    arrays = [described(name, kind) for name, kind, _ in sources]
    return found.withColumn("candidates", F.concat(*arrays)).drop(*[f"__{n}_{k}" for n, k, _ in sources])


#: Believed accuracies before any data: a yes vote on personal data, a no vote on other text.
BELIEFS = {"pattern": (0.90, 0.60), "gazetteer": (0.90, 0.40), "context": (0.80, 0.80), "shape": (0.90, 0.60)}


def fit_span_classifier(written: DataFrame, prior: float = 0.5, rounds: int = 300) -> dict[str, tuple[float, dict[str, tuple[float, float]]]]:
    """Per kind: bias and weights (vote no, vote yes) of a logistic span classifier.

    The histogram of (kind, votes) over all candidates has at most 4 * 3 ** 4 rows. Expectation-maximisation on it estimates the
    labelers' reliabilities; the logistic regression is then trained on all candidates with the posteriors as soft labels, by
    gradient steps with a small ridge, so that correlated labelers share their weight.
    """
    flat = written.select(F.explode("candidates").alias("c")).select("c.kind", *[f"c.{v}" for v in LABELERS])
    counts = sorted(((r["kind"], tuple(r[v] for v in LABELERS), r["count"]) for r in flat.groupBy("kind", *LABELERS).count().collect()),
                    key=lambda r: (r[0], tuple(-1 if v is None else v for v in r[1])))
    out = {}
    for kind in KINDS:
        patterns = [(votes, n) for k, votes, n in counts if k == kind]
        model = fit(patterns, list(LABELERS), BELIEFS, prior, strength=0.2)
        total = sum(n for _, n in patterns) or 1
        bias, weights = math.log(model.prior / (1 - model.prior)), {v: list(model.log_odds[v]) for v in LABELERS}
        soft = []
        for votes, n in patterns:
            logit = bias + sum(model.log_odds[v][x] for v, x in zip(LABELERS, votes) if x is not None)
            soft.append((votes, n / total, 1 / (1 + math.exp(-logit))))
        for _ in range(rounds):
            slope, slopes = 0.0, {v: [0.0, 0.0] for v in LABELERS}
            for votes, n, target in soft:
                logit = bias + sum(weights[v][x] for v, x in zip(LABELERS, votes) if x is not None)
                error = n * (1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))) - target)
                slope += error
                for v, x in zip(LABELERS, votes):
                    if x is not None:
                        slopes[v][x] += error
            bias -= 0.5 * slope
            for v in LABELERS:
                for x in (0, 1):
                    weights[v][x] -= 0.5 * (slopes[v][x] + 1e-4 * weights[v][x])
        out[kind] = (bias, {v: tuple(w) for v, w in weights.items()})
    return out


def _accepted(classifier: dict, c: Column) -> Column:
    """All base spans, and those that the classifier gives a probability of 0.5 or more."""
    logit = F.lit(0.0)
    for kind, (bias, weights) in classifier.items():
        own = F.lit(bias)
        for v, (no, yes) in weights.items():
            own += F.when(c[v].isNull(), F.lit(0.0)).when(c[v] == 1, F.lit(yes)).otherwise(F.lit(no))
        logit = F.when(c["kind"] == kind, own).otherwise(logit)
    return c["base"] | (logit >= 0)


def find_pii(df: DataFrame, text_col: str = "text", drop_text: bool = False, label: str = "pii-candidates") -> DataFrame:
    """Adds ``spans``: array of (rank, start, end, kind, base) ordered by kind as in :data:`KINDS`, then start.

    Regex, gazetteer, context and shape labelers vote on every candidate; expectation-maximisation weighs them and trains the
    span classifier (:func:`fit_span_classifier`), which adds candidates to the base spans and takes none away. Candidates are
    written to the shared folder with the rows (``drop_text``: without the text). Offsets count code points, the end is
    exclusive. Null and empty texts have no spans; repeated rows get the same spans; an empty table gives an empty result.
    """
    counted = with_candidates(df, text_col)
    written = materialize(counted.drop(text_col) if drop_text else counted, label)
    classifier = fit_span_classifier(written)
    ranks = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    chosen = F.transform(F.filter("candidates", lambda c: _accepted(classifier, c)), lambda c: F.struct(
        ranks[c["kind"]].alias("rank"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), c["base"].alias("base")))
    return written.withColumn("spans", F.sort_array(chosen)).drop("candidates")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans are replaced as one, by the first kind.

    ``chars_col``, where the documents have it, is set to the new length of changed texts. Other columns stay.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("__text"))
    found = find_pii(rows, "__text")
    by_start = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    kind_type = "array<struct<start:int,end:int,kind:string>>"

    def merge(acc: Column, s: Column) -> Column:
        last, end = F.element_at(acc, -1), -s["back"]
        overlaps = (F.size(acc) > 0) & (s["start"] < F.get(acc, F.size(acc) - 1)["end"])
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], end).alias("end"), last["kind"].alias("kind"))))
        added = F.concat(acc, F.array(F.struct(s["start"].alias("start"), end.alias("end"), s["kind"].alias("kind"))))
        return F.when(overlaps, grown).otherwise(added).cast(kind_type)

    merged = found.withColumn("__merged", F.when(F.size("spans") > 0, F.aggregate(by_start, F.array().cast(kind_type), merge)))
    gap = lambda s, i: F.coalesce(F.when(i > 0, F.get("__merged", i - 1)["end"]), F.lit(0))
    parts = F.transform("__merged", lambda s, i: F.concat(
        F.substring(F.col("__text"), gap(s, i) + 1, s["start"] - gap(s, i)), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    rest = F.substring(F.col("__text"), F.element_at("__merged", -1)["end"] + 1, F.char_length("__text"))
    changed = F.col("__merged").isNotNull()
    text = F.when(changed, F.concat(F.array_join(parts, ""), rest)).otherwise(F.col("__text"))
    out = merged.withColumn("__out", text)
    columns = []
    for field in docs.schema.fields:
        old = F.col("doc")[field.name]
        if field.name == text_col:
            old = F.col("__out")
        elif field.name == chars_col:
            old = F.when(changed, F.char_length("__out").cast(field.dataType)).otherwise(old)
        columns.append(old.alias(field.name))
    return out.select(*columns)
