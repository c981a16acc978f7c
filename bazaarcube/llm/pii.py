"""Personal data by weak supervision, with DataFrame functions only.

Base spans of four kinds (email, ip, card, phone) are exact patterns with their checks
and are always reported. The method adds spans of looser kinds: obfuscated addresses,
local phone numbers, social security numbers, bank accounts and credentials.

Base matches (also those that fail their check) and loose matches are candidates. Five
labelers vote on each candidate, for, against or not at all: the strict pattern and
its check, a gazetteer (domains, card and account prefixes, reserved networks), the
words before it, words that speak against it, and the look of the value. The votes of
all candidates of all documents are counted by pattern; expectation maximisation on
these counts estimates how far each labeler can be trusted and gives each pattern a
probability. A final logistic classifier on votes, kind, length and neighbouring
characters is fitted to these probabilities, weighted by the counts, and becomes a
column expression that decides which candidates are added. Only the counts, whose
number is bounded by the number of patterns, reach the driver.

Positions are in code points, end exclusive. They follow from the lengths of the
pieces between matches, so each text is passed over once for the pieces and once for
the matches. Ends are running sums in parts of the square root of their number, so a
table with a million numbers is no square.

Defined cases: a null text is empty; every row gives a row, whatever its id; overlapping spans of different base kinds are all kept; an added span never
overlaps a base span. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarcube.session import stage

# The runs below are possessive, and begin where a run begins or the last match ended:
# the same leftmost matches, without trying every suffix of a long run.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Matches are whole runs of digits with single separators; a run too short for a card of
# any length is left out, and the rest begin where no earlier digit reaches.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12}(?:[\x20-]?[0-9])*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Characters of an account number by country, where the country is known.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI NL", 19: "SI", 20: "AT EE LT LU", 21: "CH HR LI LV", 22: "BG DE GB IE", 24: "AD CZ ES RO SE SK",
    25: "PT", 26: "IS", 27: "FR GR IT MC", 28: "CY HU PL", 31: "MT",
}


def _iban() -> str:
    """A known country's number at its own length, so that no word after it is taken
    in; else groups of four with a shorter last one, 15 to 34 characters."""
    four, end = "(?: ?[A-Z0-9]{4})", "(?![A-Za-z0-9])"
    known = [
        f"(?:{'|'.join(c.split())})[0-9]{{2}}{four}{{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + end
        for n, c in IBAN_LENGTHS.items()
    ]
    other = f"[A-Z]{{2}}[0-9]{{2}}(?=(?: ?[A-Z0-9]){{11}})(?:{four}{{7}}(?: ?[A-Z0-9]{{1,2}})?|{four}{{2,6}}(?: ?[A-Z0-9]{{1,3}})?){end}"
    return f"(?:{'|'.join([*known, other])})"


# What must not stand before a match, and the match.
_WORD = "[A-Za-z0-9+/_-]"
LOOSE_PARTS = {
    # the name of a credential, a sign of assignment and a value, quoted or not
    "secret": (
        "(?<![A-Za-z0-9])",
        r"(?i:[a-z0-9]{0,20}[_-]?(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|(?:access|auth|private|secret|client)[_-]key))"
        r"""["']?[ \t]{0,3}(?::=|=>|[=:])[ \t]{0,3}(?:"[^"\n]{6,}+"|'[^'\n]{6,}+'|[^ "'\t\n\x0b\x0c\r]{6,}+)""",
    ),
    # known formats of keys, and long random words: hexadecimal, or letters of both cases with digits
    "key": (
        f"(?<!{_WORD})",
        "(?:AKIA[0-9A-Z]{16}|gh[a-z]_[A-Za-z0-9]{30,}+|xox[a-z]-[A-Za-z0-9-]{20,}+|sk[_-][A-Za-z0-9_-]{20,}+"
        r"|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"
        f"|(?=[0-9]*+[a-fA-F])(?=[a-fA-F]*+[0-9])[0-9a-fA-F]{{32,}}+(?!{_WORD})"
        f"|(?=[^0-9]{{0,40}}[0-9])(?=[^a-z]{{0,40}}[a-z])(?=[^A-Z]{{0,40}}[A-Z])[A-Za-z0-9+/]{{36,}}+={{0,2}}(?!{_WORD}))",
    ),
    "ssn": ("(?<![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "local_phone": ("(?<![0-9])", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "iban": ("(?<![A-Za-z0-9])", _iban()),
    "hidden_email": (f"(?<!{_LOCAL})", rf"{_LOCAL}{{2,64}} ?[(\[]at[)\]] ?[A-Za-z0-9-]{{2,63}} ?[(\[]dot[)\]] ?[A-Za-z]{{2,24}}"),
}
LOOSE = {kind: before + match for kind, (before, match) in LOOSE_PARTS.items()}
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + tuple(LOOSE)

# Gazetteers.
TOP_DOMAINS = "com org net edu gov int info biz io co eu uk us de fr es it nl ch at be pl pt se no dk fi ie ca au nz br mx in jp"
IBAN_COUNTRIES = " ".join(sorted(" ".join(IBAN_LENGTHS.values()).split()))
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
RESERVED_IP = r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|2(?:2[4-9]|[34][0-9]|5[0-5]))\."
CONTEXT = {
    "email": "mail|contact|write|reach|schreib|courriel|correo",
    "ip": r"\bip\b|address|server|host|login|adresse",
    "card": "card|visa|master|credit|karte|carte|tarjeta|payment",
    "phone": "phone|call|tel|mobile|fax|anruf|appel|llam",
    "secret": "login|user|account|credential",
    "key": "key|token|secret|credential|password|bearer|authorization|login",
    "ssn": "ssn|social security|security number",
    "local_phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "hidden_email": "mail|contact|write|reach",
}
AGAINST = r"(?:version|release|order|invoice|isbn|issn|part|item|serial|figure|section|page|build|v|#|no\.|nr\.)[ :.]*$"

VOTES = ("by_pattern", "by_gazetteer", "by_context", "by_contrary", "by_look")
ACCEPT = 0.9


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_INTS = "CAST(array() AS array<int>)"


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body``, in which ``name`` is ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(numbers: str, start: int, step: str) -> str:
    """SQL of the running ``step`` (of {t} and {x}, from ``start``) over an array of
    ints. The array is cut into as many parts as a part has entries: first each part
    is reduced, then the parts' starts run, then each part from its start, so arrays
    that grow by one entry at a time stay short."""

    def scan(array: str, item: str, reduced: str, first: str, after: bool) -> str:
        new = step.format(t="acc.at", x=reduced)
        kept = new if after else "acc.at"
        return (
            f"aggregate({array}, struct({first} AS at, {_INTS} AS out), (acc, {item}) ->"
            f" struct({new} AS at, concat(acc.out, array({kept})) AS out), acc -> acc.out)"
        )

    parts = "transform(sequence(0, (size(l) - 1) div w), k -> slice(l, k * w + 1, w))"
    whole = f"aggregate(a, {start}, (t, x) -> {step.format(t='t', x='x')})"
    starts = scan("b", "a", whole, str(start), False)
    inner = scan("z.a", "y", "y", "z.s", True)
    body = _let("b", parts, f"flatten(transform(zip_with(b, {starts}, (a, s) -> struct(a, s)), z -> {inner}))")
    return _let("l", numbers, f"CASE WHEN size(l) = 0 THEN {_INTS} ELSE {_let('w', 'CAST(ceil(sqrt(size(l))) AS int)', body)} END")


def _spans(name: str) -> str:
    """SQL of the spans of the matches ``m_name`` between the pieces ``p_name``: kind,
    value, start, end and the characters around."""
    m, p = f"m_{name}", f"p_{name}"
    before, after = f"slice({p}, 1, size({m}))", f"slice({p}, 2, size({m}))"
    ends = _running(f"zip_with({before}, {m}, (u, v) -> char_length(u) + char_length(v))", 0, "{t} + {x}")
    return f"""CASE WHEN size({m}) > 0 THEN transform(
      arrays_zip({m}, {before}, {after}, {ends}),
      x -> struct('{name}' AS kind, x.`{m}` AS value, x.`3` - char_length(x.`{m}`) AS s, x.`3` AS e,
        right(x.`1`, 40) AS before, left(x.`2`, 1) AS after))
      ELSE CAST(array() AS array<struct<kind:string,value:string,s:int,e:int,before:string,after:string>>) END"""


def _free(loose: str, base: str) -> str:
    """SQL of the spans ``loose`` (in order, without overlap) that no span of ``base``
    touches: among the base spans that begin before a loose one ends, the largest end must
    not be beyond its start. One sort of both, and one running maximum."""
    events = (
        f"sort_array(concat(transform({base}, b -> struct(b.s AS at, 1 AS base, b.e AS far)),"
        f" transform({loose}, x -> struct(x.e AS at, 0 AS base, 0 AS far))))"
    )
    far = _running("transform(ev, q -> q.far)", 0, "greatest({t}, {x})")
    ends = f"transform(filter(zip_with(ev, {far}, (q, f) -> struct(q.base, f AS far)), q -> q.base = 0), q -> q.far)"
    kept = f"filter(zip_with({loose}, {_let('ev', events, ends)}, (x, f) -> struct(x, f)), y -> y.f <= y.x.s)"
    return f"CASE WHEN size({loose}) = 0 OR size({base}) = 0 THEN {loose} ELSE transform({kept}, y -> y.x) END"


_DIGITS = "regexp_replace(x.value, '[^0-9]', '')"
_LUHN = f"""aggregate(sequence(1, char_length({_DIGITS})), 0, (t, i) -> t + CASE
  WHEN i % 2 = 1 THEN CAST(substr({_DIGITS}, -i, 1) AS int)
  ELSE CAST(substr({_DIGITS}, -i, 1) AS int) * 2 - CASE WHEN substr({_DIGITS}, -i, 1) > '4' THEN 9 ELSE 0 END END) % 10 = 0"""
CHECKS = {
    "email": "true",
    "ip": r"x.value rlike '^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$'",
    "card": f"CASE WHEN char_length({_DIGITS}) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"char_length({_DIGITS}) BETWEEN 8 AND 15",
}


def _one_of(words: str) -> str:
    return ", ".join(f"'{w}'" for w in words.split())


def _votes() -> dict[str, str]:
    """SQL of each labeler's vote on the candidate x (with x.valid for base kinds)."""
    domain = "lower(regexp_extract(x.value, '([A-Za-z]+)$', 1))"
    gazetteer = f"""CASE x.kind
      WHEN 'email' THEN CASE WHEN {domain} IN ({_one_of(TOP_DOMAINS)}) THEN 1 ELSE 0 END
      WHEN 'hidden_email' THEN CASE WHEN {domain} IN ({_one_of(TOP_DOMAINS)}) THEN 1 ELSE -1 END
      WHEN 'ip' THEN CASE WHEN x.value rlike {_quoted(RESERVED_IP)} THEN -1 ELSE 1 END
      WHEN 'card' THEN CASE WHEN {_DIGITS} rlike {_quoted(CARD_PREFIX)} AND char_length({_DIGITS}) >= 13 THEN 1 ELSE -1 END
      WHEN 'phone' THEN CASE WHEN {_DIGITS} rlike '^[1-9]' THEN 1 ELSE -1 END
      WHEN 'local_phone' THEN CASE WHEN {_DIGITS} rlike '^[2-9]' THEN 1 ELSE -1 END
      WHEN 'ssn' THEN CASE WHEN {_DIGITS} rlike '^(?:000|666|9)' THEN -1 ELSE 1 END
      WHEN 'iban' THEN CASE WHEN left(x.value, 2) IN ({_one_of(IBAN_COUNTRIES)}) THEN 1 ELSE -1 END
      ELSE 1 END"""
    context = "CASE x.kind " + " ".join(
        f"WHEN '{k}' THEN CASE WHEN lower(x.before) rlike {_quoted(words)} THEN 1 ELSE 0 END" for k, words in CONTEXT.items()
    ) + " ELSE 0 END"
    distinct_digits = f"size(array_distinct(split({_DIGITS}, '')))"
    look = f"""CASE WHEN x.kind = 'key' THEN 1
      WHEN x.kind = 'secret' THEN CASE WHEN x.value rlike '[=:].*[0-9]' AND x.value rlike '[=:].*[A-Za-z]' THEN 1 ELSE -1 END
      WHEN x.kind IN ('email', 'hidden_email') THEN 0
      WHEN {distinct_digits} <= 2 THEN -1
      WHEN x.kind = 'card' THEN CASE WHEN char_length({_DIGITS}) BETWEEN 16 AND 19 THEN 1 ELSE -1 END ELSE 0 END"""
    return {
        "by_pattern": f"CASE WHEN x.kind IN ({_one_of(' '.join(BASE_KINDS))}) THEN CASE WHEN x.valid THEN 1 ELSE -1 END ELSE 0 END",
        "by_gazetteer": gazetteer,
        "by_context": context,
        "by_contrary": f"CASE WHEN right(lower(x.before), 20) rlike {_quoted(AGAINST)} THEN -1 ELSE 0 END",
        "by_look": look,
    }


#: Discrete features of a candidate beside its votes.
FEATURES = {
    "size": "CASE WHEN x.e - x.s < 8 THEN 0 WHEN x.e - x.s < 16 THEN 1 WHEN x.e - x.s < 32 THEN 2 ELSE 3 END",
    "left_sign": "CASE WHEN x.before = '' THEN 0 WHEN x.before rlike '[ \\\\t\\\\n]$' THEN 1 WHEN x.before rlike '[A-Za-z0-9]$' THEN 2 ELSE 3 END",
    "right_sign": "CASE WHEN x.after = '' THEN 0 WHEN x.after rlike '[ \\\\t\\\\n]' THEN 1 WHEN x.after rlike '[A-Za-z0-9]' THEN 2 ELSE 3 END",
}


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id; ``base``: spans (kind, s, e) of the valid base matches; ``found``: all
    candidates with votes and features, a ``span`` of a base kind only if it is valid."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digit = "text rlike '[0-9]'"
    loose = "(?:" + "|".join(LOOSE.values()) + ")"
    parts = {  # pattern, and what a text must hold to have a match
        "email": (EMAIL, "instr(text, '@') > 0"),
        "ip": (IP, digit),
        "card": (CARD, digit),
        "phone": (PHONE, "instr(text, '+') > 0"),
        "loose": (loose, "text rlike '[0-9=:]|dot'"),  # every loose match has one of these
    }
    for name, (pattern, when) in parts.items():
        text = text.withColumn(f"m_{name}", F.expr(f"CASE WHEN {when} THEN regexp_extract_all(text, {_quoted(pattern)}, 0) END"))
    for name, (pattern, _) in parts.items():
        text = text.withColumn(f"p_{name}", F.expr(f"CASE WHEN size(m_{name}) > 0 THEN split(text, {_quoted(pattern)}, -1) END"))
    spans = text.select("doc_id", *(F.expr(_spans(name)).alias(name) for name in parts))
    for kind in BASE_KINDS:
        spans = spans.withColumn(kind, F.expr(f"transform({kind}, x -> struct(x.kind, x.value, x.s, x.e, x.before, x.after, {CHECKS[kind]} AS valid))"))
    kind_of = "CASE " + " ".join(f"WHEN x.value rlike {_quoted('^(?:' + match + ')')} THEN '{k}'" for k, (_, match) in LOOSE_PARTS.items()) + " ELSE 'hidden_email' END"
    spans = spans.withColumn("base", F.expr("filter(concat(email, ip, card, phone), x -> x.valid)"))
    spans = spans.withColumn("free", F.expr(_free("loose", "base")))
    spans = spans.withColumn("loose", F.expr(f"transform(free, x -> struct({kind_of} AS kind, x.value, x.s, x.e, x.before, x.after, false AS valid))"))
    votes = ", ".join(f"CAST({sql} AS int) AS {name}" for name, sql in _votes().items())
    features = ", ".join(f"{sql} AS {name}" for name, sql in FEATURES.items())
    found = f"transform(concat(email, ip, card, phone, loose), x -> struct(x.kind, x.s, x.e, x.valid, {votes}, {features}))"
    return spans.select("doc_id", F.expr("transform(base, x -> struct(x.kind, x.s, x.e))").alias("base"), F.expr(found).alias("found"))


def reliabilities(kinds: np.ndarray, votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, dict]:
    """Expectation maximisation over vote patterns. A labeler that does not vote says
    nothing; one that votes is for a true span with rate ``hit``, for a false one with
    rate ``false``. Returns each pattern's probability and the estimates."""
    n_labelers = votes.shape[1]
    hit, false, share = np.full(n_labelers, 0.8), np.full(n_labelers, 0.2), np.full(int(kinds.max(initial=0)) + 1, 0.5)
    up, down = votes > 0, votes < 0
    p = np.full(len(counts), 0.5)
    for _ in range(rounds):
        odds = np.log(share / (1 - share))[kinds] + up @ np.log(hit / false) + down @ np.log((1 - hit) / (1 - false))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        yes, no = counts * p, counts * (1 - p)
        # priors worth ten votes keep a labeler with few votes near its start
        hit = (up.T @ yes + 8) / ((up | down).T @ yes + 10)
        false = (up.T @ no + 2) / ((up | down).T @ no + 10)
        share = (np.bincount(kinds, yes, len(share)) + 1) / (np.bincount(kinds, counts, len(share)) + 2)
    return p, {"hit": hit, "false": false, "share": share}


def fit_classifier(x: np.ndarray, p: np.ndarray, counts: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic model for soft labels."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (counts * q * (1 - q))[:, None]).T @ x + np.diag(ridge), x.T @ (counts * (p - q)) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _levels() -> list[tuple[str, object]]:
    """The one-hot features: (field, value)."""
    out: list[tuple[str, object]] = [("kind", k) for k in KINDS]
    out += [(v, s) for v in VOTES for s in (-1, 1)]
    return out + [(f, i) for f in FEATURES for i in range(4)]


def learn(found: DataFrame) -> str:
    """SQL of the log-odds of a candidate x, learned from all candidates in ``found``."""
    fields = ["kind", *VOTES, *FEATURES]
    rows = found.select(F.explode("found").alias("x")).groupBy(*(F.col(f"x.{f}").alias(f) for f in fields)).agg(F.count("*").alias("n")).collect()
    if not rows:
        return "-1D"
    rows = sorted(rows, key=lambda r: tuple(r))
    kinds = np.array([KINDS.index(r["kind"]) for r in rows])
    votes = np.array([[r[v] for v in VOTES] for r in rows])
    counts = np.array([r["n"] for r in rows], float)
    p, _ = reliabilities(kinds, votes, counts)
    levels = _levels()
    x = np.array([[float(r[f] == value) for f, value in levels] for r in rows])
    w = fit_classifier(x, p, counts)
    terms = [f"{float(w[-1])!r}D"]
    for f in fields:
        cases = " ".join(f"WHEN {_quoted(v) if isinstance(v, str) else v} THEN {float(w[i])!r}D" for i, (g, v) in enumerate(levels) if g == f)
        terms.append(f"CASE x.{f} {cases} ELSE 0D END")
    return " + ".join(terms)


def _joined(spans: str) -> str:
    order = "CASE a.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    other = order.replace("a.kind", "b.kind")
    by = f"CASE WHEN {order} <> {other} THEN {order} - {other} WHEN a.s <> b.s THEN a.s - b.s ELSE a.e - b.e END"
    return f"array_join(transform(array_sort({spans}, (a, b) -> {by}), x -> concat(x.kind, ':', x.s, ':', x.e)), ',')"


def find(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, counts of base spans, their digest and all spans of every row."""
    stored = stage(candidates(docs), "pii-candidates")
    logit = learn(stored)
    cut = float(np.log(accept / (1 - accept)))
    # a match of a base kind that fails its check stays out: the kind's rule is exact
    base_kinds = _one_of(" ".join(BASE_KINDS))
    added = f"transform(filter(found, x -> x.kind NOT IN ({base_kinds}) AND {logit} >= {cut!r}D), x -> struct(x.kind, x.s, x.e))"
    counts = [F.expr(f"CAST(size(filter(base, x -> x.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in BASE_KINDS]
    return stored.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(_joined("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(_joined(f"concat(base, {added})")).alias("spans"),
    )
