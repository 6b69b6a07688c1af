"""Secret scan by a trigram index: find the texts a pattern can match, then verify them.

For every rule the trigrams that each match must contain are derived from its pattern as a
Boolean query. An inverted index of those trigrams (trigram, text) is built in one pass and
stored; grouping its postings by text intersects and unites them, and the query decides
which texts are candidates. Only candidates run the rule's regular expression. A rule
without mandatory trigrams scans every text. All steps on rows are DataFrame expressions;
Python only reads the patterns.

Spans are code-point offsets, end exclusive: the lengths of the pieces that the pattern
splits a text into, and of the matches between them, add up to each position.

Defined cases: a null or empty text has no spans; matches of one rule do not overlap, those
of different rules may; repeated rows are scanned alike; an empty table gives no rows.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass, replace
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procrisk.llm.common import beside, narrow, row_key, text_of
from procrisk.session import stage


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least``
    characters or more. Base rules come first and keep their order in the digests."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: Fixed patterns of the base rules. ``[0-9a-f]+`` of 24 or more is the same as
#: ``[0-9a-f]{24,}``, for a maximal run has no match inside another.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[opusr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
)

#: What follows the first line of a private key: lines of its header, then base64 (line ends
#: may be escaped) up to the last line, or without one the run of long base64 words.
_KEY_INFO = r"(?:\s*\n[A-Za-z-]{1,30}:[^\n]{0,200}){0,8}"
_KEY_BODY = (
    r"(?:" + _KEY_INFO + r"(?:[\s\\]++[A-Za-z0-9+/=]++){0,500}[\s\\]*-----END [A-Z ]{0,30}PRIVATE KEY-----"
    r"|" + _KEY_INFO + r"(?:[\s\\]++[A-Za-z0-9+/]{16,}+={0,2}+){1,500}"
    r"(?:\s*\n[A-Za-z0-9+/]{1,63}={0,2}(?=\s*(?:\n|$)))?)?"
)
#: Rules whose spans ``redact`` replaces: a private key goes as a whole.
REDACTED = tuple(
    replace(r, pattern=r.pattern + _KEY_BODY) if r.kind == "private_key" else r for r in RULES
)

MARK = "[SECRET]"

#: Strings kept while a pattern is analysed; more are replaced by "anything".
MAX_STRINGS = 64
#: Trigrams per mask column.
MASK_BITS = 60


# -- Boolean trigram queries ----------------------------------------------------------
# A query is True (any text), a trigram, or ("and" | "or", frozenset of queries).


def _both(op: str, parts) -> object:
    flat = set()
    for p in parts:
        if p is True:
            if op == "or":
                return True
        elif isinstance(p, tuple) and p[0] == op:
            flat |= p[1]
        else:
            flat.add(p)
    if not flat:
        return True
    if op == "or":  # whatever fulfils more than another alternative asks for adds nothing
        asked = {p: p[1] if isinstance(p, tuple) else frozenset({p}) for p in flat}
        flat = {p for p in flat if not any(asked[o] < asked[p] for o in flat)}
    return next(iter(flat)) if len(flat) == 1 else (op, frozenset(flat))


def _needs(strings: frozenset[str]) -> object:
    """A text holding one of ``strings`` holds all trigrams of that one."""
    return _both(
        "or", [_both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in strings]
    )


@dataclass(frozen=True)
class _Part:
    """What a part of a pattern matches: ``exact`` strings or None; else how its matches
    begin and end, and the trigrams they need."""

    exact: frozenset[str] | None
    first: frozenset[str]
    last: frozenset[str]
    needs: object


_ANY = _Part(None, frozenset({""}), frozenset({""}), True)


def _exactly(strings) -> _Part:
    strings = frozenset(strings)
    if len(strings) > MAX_STRINGS:
        return _ANY
    return _Part(strings, strings, strings, _needs(strings))


def _cross(a: frozenset[str], b: frozenset[str]) -> frozenset[str]:
    if len(a) * len(b) > MAX_STRINGS:
        return frozenset({""})
    return frozenset(x + y for x, y in product(a, b))


def _then(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MAX_STRINGS:
        return _exactly(_cross(a.exact, b.exact))
    first = _cross(a.exact, b.first) if a.exact is not None else a.first
    last = _cross(a.last, b.exact) if b.exact is not None else b.last
    middle = _needs(_cross(a.last, b.first))
    return _Part(None, first, last, _both("and", [a.needs, b.needs, middle]))


def _either(parts: list[_Part]) -> _Part:
    if all(p.exact is not None for p in parts):
        return _exactly(frozenset().union(*(p.exact for p in parts)))
    first = frozenset().union(*(p.first for p in parts))
    last = frozenset().union(*(p.last for p in parts))
    return _Part(None, first, last, _both("or", [p.needs for p in parts]))


def _repeat(part: _Part, low: int, high: int) -> _Part:
    if low == 0:
        return _either([_exactly({""}), part]) if high == 1 else _ANY
    known = _exactly({""})
    for _ in range(min(low, 8)):
        known = _then(known, part)
    if high == low <= 8:
        return known
    return _Part(None, known.first, known.last, known.needs)


def _analyse(tree) -> _Part:
    whole = _exactly({""})
    for op, value in tree:
        if op is rc.LITERAL:
            part = _exactly({chr(value).lower()})
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in value):
            part = _exactly({chr(v).lower() for _, v in value})
        elif op is rc.SUBPATTERN:
            part = _analyse(value[3])
        elif op is rc.BRANCH:
            part = _either([_analyse(branch) for branch in value[1]])
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            high = 1 << 30 if value[1] is rc.MAXREPEAT else value[1]
            part = _repeat(_analyse(value[2]), value[0], high)
        elif op is rc.AT:
            part = _exactly({""})
        else:
            part = _ANY
        whole = _then(whole, part)
    return whole


def trigram_query(pattern: str) -> object:
    """The Boolean query over trigrams of the lower-cased text that every text with a match
    of ``pattern`` fulfils; True if the pattern requires none."""
    return _analyse(rp.parse(pattern)).needs


def trigrams_of(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


# -- Index ----------------------------------------------------------------------------


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram number, doc_id, text_key) of ``trigrams`` in the lower-cased texts."""
    rows = narrow(docs, "doc_id", "text").select(
        "doc_id", row_key().alias("text_key"), F.lower(text_of()).alias("lowered")
    )
    held = F.array_compact(
        F.array(*(F.when(F.contains("lowered", F.lit(t)), F.lit(k)) for k, t in enumerate(trigrams)))
    )
    return rows.select("doc_id", "text_key", F.explode(held).alias("trigram"))


def _holds(query: object, number: dict[str, int]) -> Column:
    if isinstance(query, str):
        k = number[query]
        return F.getbit(f"mask_{k // MASK_BITS}", F.lit(k % MASK_BITS)) == 1
    parts = [_holds(q, number) for q in sorted(query[1], key=str)]
    whole = parts[0]
    for p in parts[1:]:
        whole = (whole & p) if query[0] == "and" else (whole | p)
    return whole


def candidates(index: DataFrame, queries: dict[str, object], trigrams: list[str]) -> DataFrame:
    """Texts that fulfil a query: doc_id, text_key and one flag ``may_<kind>`` per rule.
    The postings of a text are united bit by bit before they are shuffled."""
    number = {t: k for k, t in enumerate(trigrams)}
    masks = [
        F.bit_or(
            F.when(
                F.floor(F.col("trigram") / MASK_BITS) == w,
                F.expr(f"shiftleft(1L, trigram % {MASK_BITS})"),
            ).otherwise(F.lit(0).cast("long"))
        ).alias(f"mask_{w}")
        for w in range((len(trigrams) + MASK_BITS - 1) // MASK_BITS)
    ]
    flags = [_holds(q, number).alias(f"may_{kind}") for kind, q in queries.items()]
    found = index.groupBy("doc_id", "text_key").agg(*masks).select("doc_id", "text_key", *flags)
    return found.where(" OR ".join(f"may_{kind}" for kind in queries))


# -- Verification ---------------------------------------------------------------------


def _pieces(rule: Rule, may: Column) -> Column:
    """Lengths of the gaps before the matches, of the matches, and of their counted group."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all("text", pattern, F.lit(0))
    found = F.struct(
        F.transform(F.split("text", rule.pattern), F.length).alias("gaps"),
        F.transform(hits, F.length).alias("sizes"),
        F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.group)), F.length).alias(
            "counted"
        ),
    )
    # One match at least, or the text is not taken apart.
    return F.when(may & F.regexp_like("text", pattern), found)


def _placed(rule: Rule, order: int) -> Column:
    """Array of (start, order, end, size) of a rule's matches that are long enough."""
    parts = F.col(f"_{rule.kind}")
    one = "struct<start:int,order:int,end:int,size:int>"
    steps = F.transform(
        F.arrays_zip(F.slice(parts["gaps"], 1, F.size(parts["sizes"])), parts["sizes"], parts["counted"]),
        lambda z: F.struct(z["0"].alias("gap"), z["sizes"].alias("size"), z["counted"].alias("counted")),
    )
    state = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{one}>").alias("spans"))

    def step(s: Column, z: Column) -> Column:
        start = s["at"] + z["gap"]
        span = F.struct(
            start.alias("start"),
            F.lit(order).alias("order"),
            (start + z["size"]).alias("end"),
            z["counted"].alias("size"),
        )
        return F.struct(
            (start + z["size"]).alias("at"), F.concat(s["spans"], F.array(span)).alias("spans")
        )

    spans = F.aggregate(steps, state, step, lambda s: s["spans"])
    spans = F.filter(spans, lambda x: x["size"] >= rule.least)
    return F.coalesce(spans, F.array().cast(f"array<{one}>"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a column ``secret_spans``: array of (start, order, end, size) sorted by
    start, then by the rule's place in ``rules``."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not True}
    held = [c for c in docs.columns if c != "secret_spans"]
    rows = docs.select(F.struct(*held).alias("_row"), row_key().alias("_text_key"))
    if indexed:
        trigrams = sorted(set().union(*map(trigrams_of, indexed.values())))
        index = stage(build_index(docs, trigrams), "trigram-index")
        found = stage(candidates(index, indexed, trigrams), "trigram-candidates")
        found = beside(
            found.withColumnsRenamed({"doc_id": "_may_id", "text_key": "_may_key"}), 64
        )
        same = rows["_row"]["doc_id"].eqNullSafe(found["_may_id"]) & (
            rows["_text_key"] == found["_may_key"]
        )
        rows = rows.join(found, same, "left")
    always = F.lit(True)
    rows = rows.withColumn("text", text_of(F.col("_row")["text"]))
    rows = rows.select(
        "_row",
        *(
            _pieces(r, F.col(f"may_{r.kind}") if r.kind in indexed else always).alias(f"_{r.kind}")
            for r in rules
        ),
    )
    rows = rows.select(
        "_row",
        F.sort_array(F.concat(*(_placed(r, k) for k, r in enumerate(rules)))).alias("secret_spans"),
    )
    return rows.select("_row.*", "secret_spans")


def written(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["order"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = REDACTED, mark: str = MARK) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans become one mark.
    ``n_chars``, where present, is counted anew for changed texts."""
    found = scan(docs, rules)
    spans = F.col("secret_spans")
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, x: Column) -> Column:
        between = F.col("text").substr(s["at"] + 1, x["start"] - s["at"])
        return F.when(
            x["start"] >= s["at"],
            F.struct(
                x["end"].alias("at"),
                F.concat(s["parts"], F.array(between, F.lit(mark))).alias("parts"),
            ),
        ).otherwise(F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["parts"].alias("parts")))

    cut = F.aggregate(
        spans,
        state,
        step,
        lambda s: F.concat(
            F.array_join(s["parts"], ""),
            F.col("text").substr(s["at"] + 1, F.greatest(F.length("text") - s["at"], F.lit(0))),
        ),
    )
    clean = F.when(F.size(spans) > 0, cut).otherwise(F.col("text"))
    columns = [F.col(c) for c in docs.columns if c not in ("text", "n_chars", "secret_spans")]
    found = found.select(*columns, clean.alias("text"), *_count(docs, found, clean))
    return found.select(*docs.columns) if "secret_spans" not in docs.columns else found


def _count(docs: DataFrame, found: DataFrame, clean: Column) -> list[Column]:
    if "n_chars" not in docs.columns:
        return []
    kind = docs.schema["n_chars"].dataType
    return [
        F.when(F.size("secret_spans") > 0, F.length(clean).cast(kind))
        .otherwise(F.col("n_chars"))
        .alias("n_chars")
    ]
