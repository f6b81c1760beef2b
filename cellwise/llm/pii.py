"""Personal data by bootstrapped contextual extraction (operator 12).

Base rules find e-mail addresses, IP numbers, card numbers and phone numbers.
They are the seeds.  Every place that looks like an identifier is an instance
with lexical patterns: its form (letters, digits and signs generalised), its
form with the word before or after, and, for whole stretches of identifiers,
the words around alone.  Spark scores the graph of patterns and instances: a
pattern is trusted for a kind when the lower confidence bound of the share of
its distinct instances known to be of that kind is high (for a form, of those
known or failing the kind's check); trusted patterns make further instances
known, which may raise other patterns, until nothing is new.

So an identifier that the base rules miss (a card number right after an IP
number is swallowed with its last digits and fails its check) is found by its
form, where nearly all of that form are identifiers, or by its context.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.llm.common import fresh, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: A pattern is trusted from this lower bound of its share of known instances.
MIN_BOUND = 0.8
#: Standard deviations of the (Wilson) bound.
Z = 1.96
#: Neighbouring chunks that may be one identifier.
MAX_CHUNKS = 5
#: Characters of context taken from the word on either side.
CONTEXT = 32
#: Longer values and forms are compared by digest.
LONG = 80

# Each is as the contract's rule, but starts where a match can only start, so
# that long runs of digits or letters are read once.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CHUNK = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_LABEL = re.compile(r"[^\W\d_][\w.-]*?[:=]")
_EMAIL_WHOLE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\Z")
_CARD_WHOLE = re.compile(r"[0-9](?:[\x20-]?[0-9])+\Z")
_PHONE_WHOLE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]\Z")
_IP_WHOLE = re.compile(r"[0-9]+(?:\.[0-9]+){3}\Z")


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]+", "", s)


def luhn(digits: str) -> bool:
    """The check digit of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _ip_parts(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards: the local part is the whole run before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base rules, by start, then kind as listed."""
    out = []
    if "@" in text:
        out += [(s, e, "email") for s, e in _emails(text)]
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if _ip_parts(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def fits(value: str) -> tuple[str | None, bool]:
    """The kind that a value alone has the syntax of, and whether it passes
    that kind's check."""
    if "@" in value:
        return ("email", True) if _EMAIL_WHOLE.match(value) else (None, False)
    if value.startswith("+"):
        ok = _PHONE_WHOLE.match(value) and 10 <= len(_digits(value)) <= 15
        return ("phone", True) if ok else (None, False)
    if value.count(".") == 3 and _IP_WHOLE.match(value):
        return "ip", _ip_parts(value)
    if _CARD_WHOLE.match(value) and 14 <= len(d := _digits(value)) <= 19:
        return "card", luhn(d)
    return None, False


def _short(s: str) -> str:
    return s if len(s) <= LONG else "#" + hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def form_of(value: str) -> str:
    """Letters as one a, digits as 9: runs of four or more with their length."""
    s = re.sub(r"[^\W\d_]+", "a", value)
    return _short(re.sub(r"[0-9]+", lambda m: "9" if len(m.group()) < 4 else f"9{{{len(m.group())}}}", s))


def _word(s: str) -> str:
    return re.sub(r"[0-9]+", "0", s.lower())


def _left(text: str, start: int) -> str:
    line = re.split(r"[\n\r\v\f]", text[max(0, start - 2 * CONTEXT):start])[-1]
    # What hangs on the value itself is its punctuation.
    words = re.sub(r"[^\w\s]+\Z", "", line).split()
    return _word(words[-1][-CONTEXT:]) if words else "^"


def _right(text: str, end: int) -> str:
    line = re.split(r"[\n\r\v\f]", text[end:end + 2 * CONTEXT])[0]
    rest = re.match(r"[^\x20\t]*(.*)", line).group(1).split()
    return _word(rest[0][:CONTEXT]) if rest else "$"


def _stretches(text: str) -> Iterator[list[tuple[int, int, str | None]]]:
    """Neighbouring chunks with a digit or @, one blank apart: (start, end,
    label before) of each, without quotes and other signs around."""
    run: list[tuple[int, int, str | None]] = []
    clean_end = -1
    for m in _CHUNK.finditer(text):
        s, e, label = m.start(), m.end(), None
        while s < e and not (text[s].isalnum() or text[s] in "+("):
            s += 1
        found = _LABEL.match(text, s, e)
        if found and found.end() < e and re.search(r"[0-9@]", text[found.end():e]):
            label, s = _word(text[max(s, found.end() - CONTEXT):found.end()]), found.end()
            while s < e and not (text[s].isalnum() or text[s] in "+("):
                s += 1
        while e > s and not (text[e - 1].isalnum() or text[e - 1] == ")"):
            e -= 1
        if s >= e:
            continue
        if run and not (clean_end == run[-1][1] and m.start() == clean_end + 1 and text[clean_end] == " " and s == m.start()):
            yield run
            run = []
        run.append((s, e, label))
        clean_end = e if e == m.end() else -1
    if run:
        yield run


def instances(text: str, base: list[tuple[int, int, str]]) -> list[dict]:
    """Places that may be identifiers: start, end, value, base kind or none,
    the kind it has the syntax of, whether it passes its check, and patterns."""
    known = {(s, e): k for s, e, k in base}
    out = []
    for run in _stretches(text):
        size = [len(_digits(text[s:e])) for s, e, _ in run]
        for i, (s, _, label) in enumerate(run):
            for j in range(i, min(len(run), i + MAX_CHUNKS)):
                e = run[j][1]
                whole = i == 0 and j == len(run) - 1
                if j > i and not whole and (sum(size[i:j + 1]) < 14 and text[s] != "+" or sum(size[i:j]) >= 19):
                    continue  # neither a phone number nor a card number
                value = text[s:e]
                kind, passes = fits(value)
                if kind is None and not whole:
                    continue
                left, right = label or _left(text, s), _right(text, e)
                patterns = []
                if kind is not None:
                    form = form_of(value)
                    patterns += [f"form {form}", f"form after {left}: {form}", f"form before {right}: {form}"]
                if whole:
                    patterns += [f"words {left} _ {right}"]
                    patterns += [f"words {left} _"] if left != "^" else []
                    patterns += [f"words _ {right}"] if right != "$" else []
                out.append({"s": s, "e": e, "value": _short(value), "base": known.get((s, e)), "kind": kind,
                            "passes": passes, "patterns": patterns})
        if len(run) > MAX_CHUNKS:  # the stretch as a whole
            s, e, label = run[0][0], run[-1][1], run[0][2]
            left, right = label or _left(text, s), _right(text, e)
            out.append({"s": s, "e": e, "value": _short(text[s:e]), "base": known.get((s, e)), "kind": None,
                        "passes": False, "patterns": [f"words {left} _ {right}"]})
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


_SCAN = ("counts array<long>, base string, found array<struct<s:int,e:int,value:string,base:string,kind:string,"
         "passes:boolean,patterns:array<string>>>")


def _scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        base, found = [], []
        if t and re.search(r"[0-9@]", t):
            base = base_spans(t)
            found = instances(t, base)
        rows.append(([sum(k == kind for *_, k in base) for kind in KINDS], joined(base), found))
    return pd.DataFrame(rows, columns=["counts", "base", "found"])


def lower_bound(known: Column, n: Column) -> Column:
    """Wilson's lower bound of a share of which ``known`` of ``n`` are seen."""
    p, z2 = known / n, Z * Z
    return (p + z2 / (2 * n) - Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def _may(pattern: Column, kind: Column, own: Column, passes: Column) -> Column:
    """Whether a pattern may name an instance: by form only what passes its
    kind's check, by words what is not another kind's."""
    same = own.eqNullSafe(kind)
    return F.when(pattern.startswith("form "), same & passes).otherwise(same | ~F.coalesce(passes, F.lit(False)))


def trusted_patterns(found: DataFrame, min_bound: float = MIN_BOUND) -> tuple[DataFrame, DataFrame]:
    """Patterns (pattern, kind, bound) and known values (value, kind), from
    instances (value, base, kind, passes, patterns), scored until no new value
    is known.  Each round makes a value known, so it ends."""
    least = min_bound * Z * Z / (1 - min_bound)  # fewer instances never reach the bound
    edges = stored(found.select("value", "kind", "passes", F.explode("patterns").alias("pattern"))
                   .groupBy("pattern", "value").agg(F.first("kind").alias("own"), F.first("passes").alias("passes")), "pii_edges")
    sizes = (edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("passes")).alias("failing"))
             .where(F.col("n") >= least))
    graph = stored(edges.join(sizes, "pattern"), "pii_graph")
    known = stored(found.where(F.col("base").isNotNull()).select("value", F.col("base").alias("kind")).distinct(), "pii_known")
    while True:
        # What has a form and passes its check, but is not known, speaks neither
        # for the form nor against it.
        against = F.when(F.col("pattern").startswith("form "), F.col("failing")).otherwise(F.col("n") - F.col("hits"))
        seen = (graph.join(known, "value").groupBy("pattern", "n", "failing", "kind").agg(F.count(F.lit(1)).alias("hits"))
                .withColumn("bound", lower_bound(F.col("hits"), F.col("hits") + against)))
        patterns = stored(seen.where(F.col("bound") >= min_bound).select("pattern", "kind", "bound"), "pii_patterns")
        named = (graph.join(patterns, "pattern").where(_may(F.col("pattern"), F.col("kind"), F.col("own"), F.col("passes")))
                 .select("value", "kind").distinct())
        new = stored(named.join(known, ["value", "kind"], "left_anti"), "pii_new")
        if new.isEmpty():
            return patterns, known
        known = stored(known.unionByName(new), "pii_known")


def _merged(base: pd.Series, extra: pd.Series) -> pd.Series:
    """Base spans and those added ones that overlap nothing: surest first,
    then the longer, then the earlier."""
    out = []
    for b, more in zip(base, extra):
        if more is None or not len(more):
            out.append(b)
            continue
        spans = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in b.split(",") if x)]
        for x in sorted(more, key=lambda x: (-x["bound"], x["s"] - x["e"], x["s"], KINDS.index(x["kind"]))):
            if all(x["e"] <= s or e <= x["s"] for s, e, _ in spans):
                spans.append((int(x["s"]), int(x["e"]), x["kind"]))
        out.append(joined(spans))
    return pd.Series(out, dtype=object)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_bound: float = MIN_BOUND) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base
    matches), base_sha256, spans (base and added, "kind:start:end" by start,
    code points, end exclusive), n_added.

    An added span never overlaps a base one.  Null and empty texts have no
    spans (empty strings); repeated rows are judged each; other columns are
    not read; an empty table gives an empty result.
    """
    row = fresh(docs.select(F.col(f"`{id_col}`").alias("doc_id")), "row")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"),
                       F.monotonically_increasing_id().alias(row))
    scanned = stored(rows.select("doc_id", row, F.pandas_udf(_scan, _SCAN)("text").alias("x")).select("doc_id", row, "x.*"),
                     "pii_scanned")
    found = scanned.select(row, F.explode("found").alias("f")).select(row, "f.*")
    patterns, known = trusted_patterns(found, min_bound)
    hidden = found.where(F.col("base").isNull())
    by_pattern = (hidden.select(row, "s", "e", "kind", "passes", F.explode("patterns").alias("pattern"))
                  .join(patterns.withColumnRenamed("kind", "named"), "pattern")
                  .where(_may(F.col("pattern"), F.col("named"), F.col("kind"), F.col("passes")))
                  .select(row, "s", "e", F.col("named").alias("kind"), "bound"))
    by_value = (hidden.where("passes").join(known, ["value", "kind"]).select(row, "s", "e", "kind", F.lit(1.0).alias("bound")))
    extra = (by_pattern.unionByName(by_value).groupBy(row, "s", "e").agg(F.max(F.struct("bound", "kind")).alias("b"))
             .groupBy(row).agg(F.collect_list(F.struct("s", "e", "b.kind", "b.bound")).alias("extra")))
    n = [F.col("counts")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)]
    spans = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.pandas_udf(_merged, "string")("base", "extra"))
    out = scanned.drop("found").join(extra, row, "left").select(
        "doc_id", *n, F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"))
    size = F.when(F.col("spans") == "", 0).otherwise(F.size(F.split("spans", ",")))
    total = sum((F.col(f"n_{k}") for k in KINDS), F.lit(0))
    return out.withColumn("n_added", (size - total).cast("long"))
