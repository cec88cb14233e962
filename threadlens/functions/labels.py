"""Decision expressions around scores: thresholds, multi-hot decoding,
label parsing, argmax and arbitration. All per-row HOFs; no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.hof import let

from threadlens.schemas import (
    ASPECT_LABELS, ASPECT_THRESHOLD, ENTITY_THRESHOLD, FIRST_OPINION_MIN,
    OTHERS_PROMPT, SECOND_OPINION_MIN, SENTIMENT_LABELS, SUBJECTIVE_MIN,
)

# Which score slot means "subjective", per scorer profile.
SUBJECTIVE_SLOT = {"subjective_first": 0, "subjective_second": 1}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _labels(labels) -> Column:
    return F.array(*[F.lit(x) for x in labels])


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c)))


def threshold_strict(scores, t: float = ENTITY_THRESHOLD) -> Column:
    """array<double> -> array<int>, 1 where score > t."""
    return F.transform(_c(scores), lambda x: _gt(x, t).cast("int"))


def threshold_inclusive(scores, t: float = ASPECT_THRESHOLD) -> Column:
    """array<double> -> array<int>, 1 where score >= t."""
    return F.transform(_c(scores), lambda x: _ge(x, t).cast("int"))


def multihot_sum(v) -> Column:
    return F.aggregate(_c(v), F.lit(0), lambda a, x: a + x)


def multihot_decode(v, labels=ASPECT_LABELS, all_zero: str | None = "others") -> Column:
    """Multi-hot -> label names in slot order; all-zero -> [all_zero]."""
    names = _labels(labels)
    hits = F.filter(F.transform(_c(v), lambda x, i: F.when(x == 1, names[i])),
                    lambda n: n.isNotNull())
    if all_zero is None:
        return hits
    return F.when(multihot_sum(v) == 0, F.array(F.lit(all_zero))).otherwise(hits)


def extend_others_slot(v) -> Column:
    """13 -> 14 slots: append 1 when all zero, else 0 (values cast to int)."""
    ints = F.transform(_c(v), lambda x: x.cast("int"))
    return F.concat(ints, F.array(F.when(multihot_sum(ints) == 0, 1).otherwise(0)))


def _label_parts(text, sep: str) -> Column:
    # white space as Python's strip() sees it: Unicode spaces and the separators 1C-1F
    edge = "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$"
    return F.transform(F.split(_c(text), sep), lambda p: F.regexp_replace(F.lower(p), edge, ""))


def parse_label_list(text, labels=ASPECT_LABELS, sep: str = ";") -> Column:
    """'a; b; c' -> multi-hot over ``labels``: split, lower, strip; unknown ignored."""
    v = let(_label_parts(text, sep), lambda parts: F.transform(
        _labels(labels), lambda lab: F.array_contains(parts, lab).cast("int")))
    return F.when(_c(text).isNotNull(), v)


def unknown_label_count(text, labels=ASPECT_LABELS, sep: str = ";") -> Column:
    known = _labels(labels)
    return F.size(F.filter(_label_parts(text, sep), lambda p: ~F.array_contains(known, p)))


def first_label(v, labels) -> Column:
    """Name of the first slot equal to 1; NULL when none."""
    pos = F.array_position(_c(v), 1)
    return F.try_element_at(_labels(labels), F.nullif(pos, F.lit(0)).cast("int"))


def argmax_code(logits) -> Column:
    """Slot of the largest logit (lowest index on ties) minus 1 -> -1/0/1."""
    col = _c(logits)
    return (F.array_position(col, F.array_max(col)) - 2).cast("int")


def parse_sentiment(text, labels=SENTIMENT_LABELS) -> Column:
    """'prefix: label' -> code; token between first and second ': ',
    case-sensitive, untrimmed; missing or unknown -> 0."""
    token = F.try_element_at(F.split(_c(text), ": "), F.lit(2))
    codes = F.create_map(*[x for i, lab in enumerate(labels)
                           for x in (F.lit(lab), F.lit(i - 1))])
    return F.coalesce(F.try_element_at(codes, token), F.lit(0)).cast("int")


def code_to_sentiment(code, labels=SENTIMENT_LABELS) -> Column:
    return F.try_element_at(_labels(labels), (_c(code) + 2).cast("int"))


def label_index(name, labels=ASPECT_LABELS) -> Column:
    """Label name -> 0-based slot (NULL when unknown)."""
    return (F.nullif(F.array_position(_labels(labels), _c(name)), F.lit(0)) - 1).cast("int")


def _ge(x, t) -> Column:
    # NaN and NULL never satisfy a test (Spark orders NaN above everything).
    return F.coalesce(F.nanvl(_c(x).cast("double"), F.lit(None).cast("double")) >= F.lit(t), F.lit(False))


def _gt(x, t) -> Column:
    return F.coalesce(F.nanvl(_c(x).cast("double"), F.lit(None).cast("double")) > F.lit(t), F.lit(False))


def arbitrate(first_pred, first_conf, second_pred, second_conf,
              first_min: float = FIRST_OPINION_MIN,
              second_min: float = SECOND_OPINION_MIN) -> Column:
    return (F.when(_ge(first_conf, first_min), _c(first_pred))
             .when(_ge(second_conf, second_min), _c(second_pred))
             .otherwise(_c(first_pred)))


def entity_prompt(entity, sentence) -> Column:
    return F.concat(F.lit("entity of interest: "),
                    F.replace(_c(entity), F.lit("others"), F.lit(OTHERS_PROMPT)),
                    F.lit(" [SEP] "), _c(sentence))


def entity_aspect_prompt(entity, aspect, sentence) -> Column:
    return F.concat(F.lit("entity of interest: "),
                    F.replace(_c(entity), F.lit("others"), F.lit(OTHERS_PROMPT)),
                    F.lit(" [SEP] aspect of interest: "), _c(aspect),
                    F.lit(" [SEP] "), _c(sentence))


def score_of_label(labels, scores, name: str | Column) -> Column:
    """Score of a named label from parallel label/score arrays."""
    return F.try_element_at(F.map_from_arrays(_c(labels), _c(scores)), F.lit(name))


def subjective_flag(scores, profile: str, threshold: float = SUBJECTIVE_MIN,
                    profiles=SUBJECTIVE_SLOT) -> Column:
    """1 if the profile's subjective slot scores > threshold, else 0;
    an unknown profile gives NULL (no decision)."""
    slot = profiles.get(profile)
    if slot is None:
        return F.lit(None).cast("int")
    return _gt(_c(scores)[slot], threshold).cast("int")
