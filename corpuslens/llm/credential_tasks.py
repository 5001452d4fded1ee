"""Spans of secrets inside a text. Nothing here knows Spark."""

import re
from bisect import bisect_right
from string import ascii_lowercase

import pyarrow as pa

# The base kinds, in their order.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")

# Weak candidates, which count only together. The value is the last group.
WEAK_ID = re.compile(
    r"""(?i:access|client|account|user|tenant|key)[_-]?(?i:key[_-]?)?(?i:id|name)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{4,})""",
    re.ASCII,
)
# A key-like run has 32 characters at least, 24 random bytes in base64: shorter runs with mixed
# characters are often names. It has no upper bound, since only a partner makes it a secret.
WEAK_KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])([A-Za-z0-9+/_-]{32,}={0,2})(?![A-Za-z0-9+/=_-])")
# An endpoint is a scheme, "://" and a place: one of these, or jdbc: and a name, or a name that ends
# with "sql" or "+sql".
SCHEMES = ("http", "https", "s3", "ftp", "mongodb", "redis", "amqp")
PLACE = re.compile(r"[^\s\"'<>]{4,}")
SCOPE = 300  # code points before and after an identifier, at least
BRACES = re.compile(r"[{}]")
SETTING = re.compile(r"""[ \t]*(?:export[ \t]+|-[ \t]+)?["']?[\w.-]+["']?[ \t]*[:=][ \t]*(?:"[^"]*"|'[^']*'|\S*)[ \t]*[,;]?\r?""")


def base(text):
    """Spans ``(start, kind number, end)`` of the base kinds."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _mixed(value):
    """A key-like string: upper case, lower case and digits, and many different characters."""
    return (
        any(map(str.isdigit, value))
        and any(map(str.isupper, value))
        and any(map(str.islower, value))
        and len(set(value)) >= 12
    )


def _scheme(before):
    """Where the longest scheme that ``before`` ends with starts in it, or None."""
    head = before.rstrip(ascii_lowercase)
    name = before[len(head) :]
    starts = [len(before) - len(s) for s in SCHEMES if before.endswith(s)]
    if name.endswith("sql") and len(name) > 3:
        starts.append(len(head))
    elif name == "sql" and head.endswith("+"):
        driver = head[:-1].rstrip(ascii_lowercase)
        if len(driver) < len(head) - 1:
            starts.append(len(driver))
    if name and head.endswith("jdbc:"):
        starts.append(len(head) - 5)
    return min(starts, default=None)


def endpoints(text):
    """Spans ``(start, kind number, end)`` of endpoints, found from their "://", so that a long run of
    letters is looked at once."""
    found, at = [], 0
    while (colon := text.find("://", at)) >= 0:
        start = _scheme(text[at:colon])
        place = None if start is None else PLACE.match(text, colon + 3)
        if place is None:
            at = colon + 1
        else:
            found.append((at + start, 5, place.end()))
            at = place.end()
    return found


def _by_place(spans):
    """Spans by kind, each with its ends: those of one kind are apart, so both are sorted."""
    kinds = {}
    for span in spans:
        kinds.setdefault(span[1], []).append(span)
    return [(own, [end for _, _, end in own]) for own in map(sorted, kinds.values())]


def _overlapping(by_place, low, high):
    """Spans that meet the interval."""
    for spans, ends in by_place:
        at = bisect_right(ends, low)
        while at < len(spans) and spans[at][0] < high:
            yield spans[at]
            at += 1


def _objects(text, ids):
    """Of each identifier the innermost ``{...}`` around it, if any. Braces count as they stand."""
    found, open_, waiting = {}, [], sorted(ids, reverse=True)
    inside = []  # of each open brace, the identifiers that have no smaller object yet
    for m in BRACES.finditer(text):
        while waiting and waiting[-1][0] < m.start():
            span = waiting.pop()
            if open_:
                inside[-1].append(span)
        if m[0] == "{":
            open_.append(m.start())
            inside.append([])
        elif open_:
            start = open_.pop()
            for span in inside.pop():
                found.setdefault((start, m.end()), []).append(span)
    return found


def _settings(text, ids):
    """Of each identifier the run of two or more lines ``name = value`` that it is in, if any."""
    found, last, other = {}, (0, 0), (0, 0)

    def line(at):
        end = text.find("\n", at)
        return text.rfind("\n", 0, at) + 1, len(text) if end < 0 else end

    for span in sorted(ids):
        if last[0] <= span[0] < last[1]:
            found[last].append(span)
            continue
        if other[0] <= span[0] < other[1]:  # the same line, which is no setting
            continue
        start, end = other = line(span[0])
        if not SETTING.fullmatch(text, start, end):
            continue
        lines = 1
        while start > 0:
            above = line(start - 1)
            if not SETTING.fullmatch(text, *above):
                break
            start, lines = above[0], lines + 1
        while end < len(text):
            below = line(end + 1)
            if not SETTING.fullmatch(text, *below):
                break
            end, lines = below[1], lines + 1
        if lines > 1:
            last = (start, end)
            found[last] = [span]
    return found


def linked(text, found):
    """Weak candidates whose complements are in one scope with them.

    An interval join: an identifier's scope reaches ``SCOPE`` code points to both sides, and
    over the whole object in braces and the whole run of setting lines that it is in. If
    a secret, of the base kinds or weak, meets the scope, then the identifier, the weak secrets
    and the endpoints that meet it are reported, save what lies in a base span. A secret
    and an endpoint without an identifier are not linked.
    """
    ids = [(s, 3, e) for s, kind, e in found if kind == 1]
    if "=" in text or ":" in text:
        ids += [(m.start(1), 3, m.end(1)) for m in WEAK_ID.finditer(text)]
    if not ids:
        return []
    access = {(s, e) for s, kind, e in found if kind == 1}
    secrets = sorted(
        [s for s in found if s[1] != 1]
        + [(m.start(1), 4, m.end(1)) for m in WEAK_KEY.finditer(text) if _mixed(m[1]) and m.span(1) not in access]
    )
    if not secrets:
        return []
    secrets, places, known = map(_by_place, (secrets, endpoints(text), found))
    reported = set()
    scopes = [((start - SCOPE, end + SCOPE), [(start, kind, end)]) for start, kind, end in sorted(ids)]
    scopes += [*_objects(text, ids).items(), *_settings(text, ids).items()]
    for scope, own in scopes:
        partners = list(_overlapping(secrets, *scope))
        apart = lambda x, others: any(s[0] >= x[2] or s[2] <= x[0] for s in others)
        own = [i for i in own if apart(i, partners)]
        if own:
            reported.update(own)
            reported.update(s for s in partners if s[1] == 4 and apart(s, own))
            reported.update(_overlapping(places, *scope))
    return sorted(
        span
        for span in reported
        if not any(s <= span[0] and span[2] <= e for s, _, e in _overlapping(known, span[0], span[2]))
    )


def scanned(texts):
    """A struct per text: the base spans, and those with the linked ones."""
    rows = []
    for text in texts.to_pylist():
        found = base(text or "")
        rows.append((found, sorted(found + linked(text, found)) if text else found))

    def column(which):
        return pa.array(
            [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in row[which]] for row in rows],
            pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])),
        )

    return pa.StructArray.from_arrays([column(0), column(1)], ["base", "spans"])
