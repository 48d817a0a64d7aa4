"""Secret scans (operator 9): base patterns, and multipart credentials by linking.

A credential often stands in parts: an access identifier, a secret and an endpoint.
Each part alone is weak evidence.  Parts are found as spans; the interval of each is its
scope (a paragraph: text without a blank line), or with a bound ``reach`` so many
characters to both sides of it within the scope.  Two parts of different roles are linked
when their intervals overlap, a join of intervals by one sweep in start order, which keeps
for each role only the reach of the spans seen so far and so never lists pairs.  A weak candidate is reported
only when it is linked; base spans are always reported.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base kinds, in order.
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
MIN_ASSIGNED = 6
#: A text without any of these has no assign match.
ASSIGN_WORDS = ("passw", "secret", "token", "api")

#: Weak parts by role; group 1 is the span where there is one.
WEAK = (
    ("id", re.compile(r"""(?:client|account|user|access|tenant|app)[_ -]?(?:id|name)?["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{4,})""", re.I | re.A)),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])([A-Za-z0-9+/_-]{20,}={0,2})")),
    ("endpoint", re.compile(r"""(?:https?|ftp|jdbc:[a-z]+|mongodb|postgres(?:ql)?|mysql|redis|amqp|s3)://[^\s"'<>]{3,}""", re.A)),
    ("endpoint", re.compile(r"""(?:host|server|endpoint|bucket)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._-]{4,})""", re.I | re.A)),
)
KINDS = ("assign", "access", "hex", "part_id", "part_secret", "part_endpoint")
#: What a base span counts as when parts are linked.
ROLE_OF = {"assign": "secret", "access": "id", "hex": "secret"}
PARAGRAPH = re.compile(r"\n[\x20\t\r]*\n")


@dataclass(frozen=True)
class LinkRules:
    """``reach``: characters that a part reaches to either side, so that parts are linked up to twice as
    far apart; None: to the ends of its scope."""

    reach: int | None = None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, each kind leftmost and non-overlapping."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def weak_parts(text: str) -> list[tuple[int, int, str]]:
    found = []
    for role, pattern in WEAK:
        found += [(*(m.span(1) if pattern.groups else m.span()), f"part_{role}") for m in pattern.finditer(text)]
    return found


def linked(text: str, base: list[tuple[int, int, str]], weak: list[tuple[int, int, str]], reach: int | None) -> list[tuple[int, int, str]]:
    """The weak parts with a part of another role within reach in their paragraph."""
    if not weak or len(base) + len(weak) < 2:
        return []
    breaks = [m.start() for m in PARAGRAPH.finditer(text)]
    parts = sorted((s, e, kind, ROLE_OF.get(kind) or kind[5:]) for s, e, kind in {*base, *weak})
    hit = [False] * len(parts)
    for order in (range(len(parts)), range(len(parts) - 1, -1, -1)):
        scope, far = None, {}
        forward = order.step > 0
        for i in order:
            s, e, _, role = parts[i]
            here = bisect.bisect_right(breaks, s)
            if here != scope:
                scope, far = here, {}
            # forward: ends seen; backward: starts seen (the least start of what follows)
            for other, edge in far.items():
                if other != role and (reach is None or (s - edge if forward else edge - e) <= 2 * reach):
                    hit[i] = True
            best = far.get(role)
            mark = e if forward else s
            far[role] = mark if best is None else max(best, mark) if forward else min(best, mark)
    covered = sorted((s, e) for s, e, _ in base)
    starts = [s for s, _ in covered]
    ends = list(itertools.accumulate((e for _, e in covered), max))  # the furthest end up to each start
    out = []
    for (s, e, kind, _), h in zip(parts, hit):
        if not h or not kind.startswith("part_"):
            continue
        k = bisect.bisect_right(starts, s) - 1  # a part inside base spans says nothing new
        if k >= 0 and e <= ends[k]:
            continue
        out.append((s, e, kind))
    return out


def scan_text(text: str, rules: LinkRules = LinkRules()) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and reported weak parts of one text, each by start, then kind."""
    base = base_spans(text)
    key = lambda x: (x[0], KINDS.index(x[2]), x[1])
    return sorted(base, key=key), sorted(linked(text, base, weak_parts(text), rules.reach), key=key)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan_secrets(docs: DataFrame, rules: LinkRules = LinkRules()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, n_linked, spans.

    ``spans`` has all spans as kind:start:end (code points, end exclusive) by start, then
    kind in the order of ``KINDS``.  A null or empty text has none.  Whole texts are
    scanned, each in one task's memory.
    """

    def run(batches):
        key = lambda x: (x[0], KINDS.index(x[2]), x[1])
        for batch in batches:
            ids, rows = batch.column(0), []
            for text in batch.column(1):
                base, weak = scan_text(text.as_py() or "", rules)
                n = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), len(weak), joined(sorted(base + weak, key=key))))
            cols = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [ids, *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "n_linked", "spans"])

    return docs.select("doc_id", F.col("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
             "base_sha256 string, n_linked long, spans string")
