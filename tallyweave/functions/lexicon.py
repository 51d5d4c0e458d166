"""Relevance and name scores from weighted lexicons.

A lexicon is a small list of (group, keyword) that the caller supplies; it is
turned into column expressions, so scoring is part of the scan's own stage.
Scores are exact decimals, rounded half up.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import band, col, let, normalize_text, score_of, text_or_empty

REASON_WORDS = 12
#: A pattern that matches nothing.
NEVER = "(?!)"


@dataclass(frozen=True)
class Lexicon:
    """Keyword groups with weights; `strong` words add a bonus, negatives take away."""

    groups: Mapping[str, Sequence[str]]
    weights: Mapping[str, float] = field(default_factory=dict)
    strong: Sequence[str] = ()
    hard_negatives: Sequence[str] = ()
    soft_negatives: Sequence[str] = ()


def has_keyword(text: Column, keyword: str) -> Column:
    """Keyword between characters that are no ASCII letters or digits; other scripts match anywhere."""
    if not keyword.isascii():
        return text.contains(keyword)
    return text.contains(keyword.lower()) & text.rlike(f"(?<![a-z0-9]){re.escape(keyword.lower())}(?![a-z0-9])")


def matched(text: Column, keywords: Sequence[str]) -> Column:
    """Keywords of the list that the (normalised) text has."""
    hits = [F.when(has_keyword(text, k), F.lit(k)) for k in keywords]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def total(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts, F.lit(0).cast("decimal(9,4)"))


def number(x: float) -> Column:
    return F.lit(str(x)).cast("decimal(9,4)")


def clamp(score: Column) -> Column:
    return F.greatest(number(0), F.least(number(1), score))


def result(score: Column, keywords: Column, accept: float, review: float) -> Column:
    rounded = score_of(score)
    reason = F.array_join(F.slice(F.array_sort(keywords), 1, REASON_WORDS), ", ")
    return F.struct(rounded.alias("score"), band(rounded, accept, review).alias("status"), (rounded >= accept).alias("is_relevant"), reason.alias("reason"), keywords.alias("keywords"))


def score_fields(fields: Mapping[str, tuple[Column | str, float]], lexicon: Lexicon, accept: float = 0.75, review: float = 0.45) -> Column:
    """struct(score, status, is_relevant, reason, keywords) of several weighted fields.

    Each group that a field hits adds weight * min(1, .55 + .15 * hits); strong
    words add up to .2, two groups or more .1; any hit lifts the score to
    `review` at least; negatives take .25 and .08 away.
    """
    texts = {name: normalize_text(c) for name, (c, _) in fields.items()}
    everything = F.concat_ws(" ", *texts.values())
    parts, groups_hit, keywords = [], [], F.array().cast("array<string>")
    for words in lexicon.groups.values():
        seen = F.array().cast("array<string>")
        for name, (_, weight) in fields.items():
            hits = matched(texts[name], words)
            parts.append(F.when(F.size(hits) > 0, number(weight) * F.least(number(1), number(0.55) + number(0.15) * F.size(hits))).otherwise(number(0)))
            seen = F.array_union(seen, hits)
        groups_hit.append(F.when(F.size(seen) > 0, 1).otherwise(0))
        keywords = F.array_union(keywords, seen)
    score = total(parts) + F.least(number(0.2), number(0.08) * F.size(matched(everything, lexicon.strong)))
    score += F.when(reduce(lambda a, b: a + b, groups_hit, F.lit(0)) >= 2, number(0.1)).otherwise(number(0))
    score = F.when(F.size(keywords) > 0, F.greatest(number(review), score)).otherwise(score)
    score -= F.when(F.size(matched(everything, lexicon.hard_negatives)) > 0, number(0.25)).otherwise(number(0))
    score -= F.when(F.size(matched(everything, lexicon.soft_negatives)) > 0, number(0.08)).otherwise(number(0))
    return result(clamp(score), keywords, accept, review)


def score_text(texts: Sequence[Column | str], lexicon: Lexicon, accept: float = 0.6, review: float = 0.35) -> Column:
    """The same for one text: group weight * min(1, .55 + .15 * hits), negatives -.35 and -.15."""
    lists = {**lexicon.groups, "hard negatives": lexicon.hard_negatives, "soft negatives": lexicon.soft_negatives}

    def scored(hits: Column) -> Column:
        parts, keywords = [], F.array().cast("array<string>")
        for k, group in enumerate(lexicon.groups):
            weight = number(lexicon.weights.get(group, 0.35))
            n = F.size(hits[f"h{k}"])
            parts.append(F.when(n > 0, weight * F.least(number(1), number(0.55) + number(0.15) * n)).otherwise(number(0)))
            keywords = F.array_union(keywords, hits[f"h{k}"])
        score = total(parts)
        score -= F.when(F.size(hits[f"h{len(lists) - 2}"]) > 0, number(0.35)).otherwise(number(0))
        score -= F.when(F.size(hits[f"h{len(lists) - 1}"]) > 0, number(0.15)).otherwise(number(0))
        return let(F.struct(clamp(score).alias("score"), keywords.alias("keywords")), lambda x: result(x["score"], x["keywords"], accept, review))

    text = normalize_text(F.concat_ws(" ", *(text_or_empty(t) for t in texts)))
    found = let(text, lambda t: F.struct(*(matched(t, words).alias(f"h{k}") for k, words in enumerate(lists.values()))))
    return let(found, scored)


@dataclass(frozen=True)
class NameRules:
    """What the rule scorer knows: all of it supplied by the caller; an empty set switches a rule off."""

    tokens: Sequence[str] = ()
    stop_tokens: Sequence[str] = ()
    script: str = ""
    token_shape: str = ""
    context: str = ""


def score_name(name: Column | str, rules: NameRules, context: Column | str = "", accept: float = 0.70) -> Column:
    """struct(score, flag, reason): an additive rule score of a name's tokens.

    The score annotates a row; callers choose whether to filter on it.
    """
    raw = text_or_empty(name)
    parts = F.filter(F.split(normalize_text(name), r"[^\p{L}]+"), lambda t: t != "")
    known = F.array(*map(F.lit, rules.tokens)) if rules.tokens else F.array().cast("array<string>")
    stops = F.array(*map(F.lit, rules.stop_tokens)) if rules.stop_tokens else F.array().cast("array<string>")
    ends = F.array_distinct(F.array_compact(F.array(F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(-1)))))
    others = F.filter(parts, lambda t: ~F.array_contains(known, t))
    checks = [
        (F.arrays_overlap(ends, known), 0.45, "lexicon token"),
        ((F.size(others) > 0) & F.forall(others, lambda t: t.rlike(rules.token_shape or NEVER)), 0.20, "token shape"),
        (F.exists(parts, lambda t: F.length(t) == 1), 0.10, "initial"),
        (normalize_text(col(context) if not isinstance(context, str) or context else F.lit("")).rlike(rules.context or NEVER), 0.15, "context"),
        (F.size(parts).between(2, 4), 0.05, "length"),
    ]
    added = F.least(number(0.95), total([F.when(c, number(x)).otherwise(number(0)) for c, x, _ in checks]))
    reasons = F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(r)) for c, _, r in checks))), ", ")
    in_script = raw.rlike(rules.script or NEVER)
    stopped = F.arrays_overlap(parts, stops)
    score = score_of(F.when(in_script, number(0.98)).when(stopped, number(0.05)).otherwise(added))
    reason = F.when(in_script, "script").when(stopped, "stop token").otherwise(reasons)
    return F.struct(score.alias("score"), (score >= accept).cast("int").alias("flag"), reason.alias("reason"))
