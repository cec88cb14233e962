"""Mention rewrite from clusters (exact), plus a rule-based cluster producer.

Text is tokenised into ``array<struct<idx, text, ws>>`` (``idx`` = token
position, ``ws`` = trailing whitespace). Clusters are
``array<array<struct<tok_start, tok_end>>>`` (inclusive token ranges).

Rewrite rules, per cluster in order: the key mention is the first mention
whose text contains any gazetteer term (case-insensitive). Then every
mention of the cluster becomes the key text: mentions before the key take
the *key's* first-token whitespace, the key and later mentions their own;
the other tokens of a rewritten mention become ''. Clusters without a key
are untouched; a later cluster overwrites an earlier one on the same token.
Everything is per-row higher-order functions: no Python, no shuffle.

The cluster producer is a rule, not a trained coreference model: each
third-person pronoun joins the nearest preceding gazetteer-hit token.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.hof import let

# Third-person pronouns the rule producer links.
PRONOUNS = ["he", "him", "his", "she", "her", "hers", "it", "its", "they", "them", "their"]

TOKEN_RE = "(?U)\\w+|[^\\w\\s]"
TOKEN_WS_RE = "(?U)(?:\\w+|[^\\w\\s])(\\s*)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """array<struct<idx:int, text:string, ws:string>> of word/punctuation tokens."""
    col = _c(text)
    return let(F.struct(F.regexp_extract_all(col, F.lit(TOKEN_RE), 0).alias("t"),
                        F.regexp_extract_all(col, F.lit(TOKEN_WS_RE), 1).alias("w")),
               lambda tw: F.transform(tw["t"], lambda t, i: F.struct(
                   i.alias("idx"), t.alias("text"), tw["w"][i].alias("ws"))))


def leading_ws(text) -> Column:
    return F.regexp_extract(_c(text), "^(?U)\\s*", 0)


def _mention_text(tokens: Column, m: Column) -> Column:
    span = F.slice(tokens, m["tok_start"] + 1, m["tok_end"] - m["tok_start"] + 1)
    n = F.size(span)
    return F.array_join(F.transform(span, lambda t, j: F.concat(
        t["text"], F.when(j < n - 1, t["ws"]).otherwise(F.lit("")))), "")


def _has_term(s: Column, terms: list[str]) -> Column:
    arr = F.array(*[F.lit(t) for t in terms])
    low = F.lower(s)
    return F.exists(arr, lambda t: low.contains(t))


_ENTRY = "array<struct<pos:int,text:string>>"


def _cluster_entries(tk: Column, cluster: Column, low_terms: list[str]) -> Column:
    """(pos, text) writes of one cluster, in the order they happen."""
    hits = F.transform(cluster, lambda m: _has_term(_mention_text(tk, m), low_terms))

    def with_key(key_pos):                                  # 1-based, 0 = none
        key = F.try_element_at(cluster, F.greatest(key_pos, F.lit(1)).cast("int"))
        return F.struct(key_pos.alias("kp"), _mention_text(tk, key).alias("kt"),
                        tk[key["tok_start"]]["ws"].alias("kw"))
    info = let(F.array_position(hits, F.lit(True)), with_key)

    def writes(k):
        def mention_entries(m, j):
            first_ws = F.when(j + 1 < k["kp"], k["kw"]).otherwise(tk[m["tok_start"]]["ws"])
            return F.transform(
                F.sequence(m["tok_start"], m["tok_end"]),
                lambda p: F.struct(p.alias("pos"), F.when(p == m["tok_start"],
                                                          F.concat(k["kt"], first_ws))
                                   .otherwise(F.lit("")).alias("text")))
        return F.when(k["kp"] > 0, F.flatten(F.transform(cluster, mention_entries))) \
                .otherwise(F.array().cast(_ENTRY))
    return let(info, writes)


def rewrite_mentions(tokens, clusters, terms: Iterable[str], prefix=None) -> Column:
    """Rebuilt text after replacing cluster mentions by their key mention."""
    low_terms = sorted({t.lower() for t in terms if t})

    def with_tokens(tk):
        entries = F.flatten(F.transform(_c(clusters), lambda c: _cluster_entries(tk, c, low_terms)))
        # last write wins: sort by (pos, -write order) and keep the first per pos
        ordered = F.array_sort(F.transform(entries, lambda e, i: F.struct(
            e["pos"].alias("pos"), (-i).alias("nseq"), e["text"].alias("text"))))

        def to_map(srt):
            firsts = F.filter(srt, lambda x, i: (i == 0) | (srt[i - 1]["pos"] != x["pos"]))
            return F.map_from_entries(F.transform(firsts, lambda x: F.struct(x["pos"], x["text"])))

        def render(m):
            return F.array_join(F.transform(tk, lambda t: F.coalesce(
                F.try_element_at(m, t["idx"]), F.concat(t["text"], t["ws"]))), "")
        return let(let(ordered, to_map), render)
    body = let(_c(tokens), with_tokens)
    return body if prefix is None else F.concat(_c(prefix), body)


_PY_TOKEN = re.compile(r"\w+|[^\w\s]")


def _terms_by_width(terms: Iterable[str]) -> dict[int, list[str]]:
    """Lower-cased terms grouped by how many tokens they span."""
    by: dict[int, set[str]] = {}
    for t in terms:
        if t:
            by.setdefault(max(1, len(_PY_TOKEN.findall(t))), set()).add(t.lower())
    return {k: sorted(v) for k, v in by.items()}


def _hit_spans(tk: Column, n: Column, by_width: dict[int, list[str]]) -> Column:
    """Token spans whose text contains a gazetteer term, leftmost-longest and
    non-overlapping: array<struct<s:int, e:int>> sorted by start."""
    idxs = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))

    def spans_of_width(k: int, ts: list[str]) -> Column:
        arr = F.array(*[F.lit(t) for t in ts])

        def window(i):
            parts = []
            for j in range(k):
                parts.append(tk[i + j]["text"])
                if j < k - 1:
                    parts.append(tk[i + j]["ws"])
            return F.lower(F.concat(*parts))

        def starts_here(i):
            return (i + k <= n) & let(window(i), lambda w: F.exists(arr, lambda t: w.contains(t)))

        def span(i):
            return F.struct(i.alias("s"), F.lit(-k).alias("neg_len"), (i + k - 1).alias("e"))
        return F.transform(F.filter(idxs, starts_here), span)

    spans = [spans_of_width(k, ts) for k, ts in sorted(by_width.items())]
    ordered = F.array_sort(F.flatten(F.array(*spans)))   # by start, longest first
    picked = F.aggregate(
        ordered, F.array().cast("array<struct<s:int,neg_len:int,e:int>>"),
        lambda acc, x: F.when((F.size(acc) == 0) | (x["s"] > F.element_at(acc, -1)["e"]),
                              F.concat(acc, F.array(x))).otherwise(acc))
    return F.transform(picked, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))


def pronoun_clusters(tokens, terms: Iterable[str], pronouns=PRONOUNS) -> Column:
    """Rule producer: cluster = [gazetteer-hit mention, following pronouns up
    to the next hit]; clusters without a pronoun are dropped. A hit is one
    token containing a single-token term, or a run of tokens whose text
    contains a term spanning several tokens (leftmost-longest)."""
    by_width = _terms_by_width(terms)
    pro = F.array(*[F.lit(p) for p in pronouns])
    single = by_width.get(1, [])
    multi = {k: v for k, v in by_width.items() if k > 1}
    term_arr = F.array(*[F.lit(t) for t in single])

    def with_tokens(tk):
        n = F.size(tk)
        idxs = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
        # one pass over the tokens: lower-case once, tag hits and pronouns
        tags = F.transform(tk, lambda t: let(F.lower(t["text"]), lambda low: F.struct(
            F.exists(term_arr, lambda x: low.contains(x)).alias("hit"),
            F.array_contains(pro, low).alias("pron"))))

        def split_tags(tg):
            prons = F.filter(idxs, lambda i: (n > 0) & tg[i]["pron"])
            if multi:
                hits = _hit_spans(tk, n, by_width)
            else:
                hits = F.transform(F.filter(idxs, lambda i: (n > 0) & tg[i]["hit"]),
                                   lambda i: F.struct(i.alias("s"), i.alias("e")))
            return F.struct(hits.alias("h"), prons.alias("p"))

        def build(v):
            nh = F.size(v["h"])

            def one(h, k):
                nxt = F.when(k + 1 < nh, v["h"][k + 1]["s"]).otherwise(n)
                ps = F.filter(v["p"], lambda p: (p > h["e"]) & (p < nxt))
                span = lambda a, b: F.struct(a.alias("tok_start"), b.alias("tok_end"))
                return F.concat(F.array(span(h["s"], h["e"])), F.transform(ps, lambda p: span(p, p)))
            return F.filter(F.transform(v["h"], one), lambda c: F.size(c) > 1)
        return let(let(tags, split_tags), build)
    return let(_c(tokens), with_tokens)


def rule_rewrite(terms: Iterable[str], pronouns=PRONOUNS):
    """A ``thread_context`` rewrite: tokenise, produce clusters, rewrite.

    Texts without a gazetteer hit or without a pronoun have no cluster, and
    rebuilding their tokens gives the text back unchanged, so a cheap native
    pre-check skips the token work for them (CASE evaluates lazily).
    """
    terms = list(terms)
    low_terms = sorted({t.lower() for t in terms if t})
    pron_re = "(?iU)\\b(" + "|".join(pronouns) + ")\\b"

    def rw(text: Column) -> Column:
        full = let(tokenize(text), lambda tk: rewrite_mentions(
            tk, pronoun_clusters(tk, terms, pronouns), terms, leading_ws(text)))
        low = F.lower(text)
        needs = F.exists(F.array(*[F.lit(t) for t in low_terms]), lambda t: low.contains(t)) \
            & text.rlike(pron_re)
        return F.when(needs, full).otherwise(text)
    return rw
