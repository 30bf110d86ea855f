"""Brute-force versions that several tests use."""

import hashlib

SPACE = " \t\n\r\x0b\x0c"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def split(line):
    return lower("".join(" " if c in SPACE else c for c in line)).split(" ")


def line_sets(rows):
    """(order, words in order) of every line with a word."""
    out = []
    seen = {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, _sha(r[1]))):
        seen[doc] = seen.get(doc, 0) + 1
        for k, line in enumerate((text or "").split("\n")):
            found = [w for w in split(line) if w]
            if found:
                out.append(((doc, seen[doc], k), found))
    return out


def _sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def jaccard_at_least(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def brute_lines(rows):
    lines = [(place, frozenset(found)) for place, found in line_sets(rows)]
    distinct = list(dict.fromkeys(s for _, s in lines))
    links = {s: sum(1 for o in distinct if o != s and jaccard_at_least(s, o)) for s in distinct}
    out = []
    for i, (place, found) in enumerate(lines):
        removed = any(jaccard_at_least(found, other) for _, other in lines[:i])
        out.append((place[0], place[2], links[found], removed))
    return sorted(out, key=str)


def brute_runs(rows, run=20, least=50, shingle=5, every_window=False):
    """Every run that begins where the words say, its component and whether it goes: all pairs compared.

    Hashes of the opening words come from the operator; the rule of the places is said anew here.
    """
    import numpy as np

    from stationlake.llm import paragraphs
    from stationlake.llm.hashing import words as hashed

    window = least - run - 2 + 1
    found = []
    seen = {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, _sha(r[1]))):
        seen[doc] = seen.get(doc, 0) + 1
        body = [w for w in split((text or "").replace("\n", " ")) if w]
        code = paragraphs._hashes(hashed([(text or "").encode()])[0], 3).tolist()
        able = range(2, len(body) - max(run, 5) + 1)
        low = {
            p: code[p] for p in able if code[p] < min(code[p - 1], code[p - 2]) and code[p] <= min(code[p + 1 : p + 3])
        }
        begin = set()
        for s in range(0, len(body) - window - run + 2):
            inside = [p for p in range(s, s + window) if p in low]
            if every_window and not inside:
                inside = [p for p in range(s, s + window) if p in able]
            if inside:
                begin.add(min(inside, key=lambda p: (code[p], p)))
        for p in sorted(begin):
            part = body[p : p + run]
            found.append(((doc, seen[doc], p), frozenset(tuple(part[i : i + shingle]) for i in range(run - shingle + 1))))
    holders = {}
    for i, (_, s) in enumerate(found):
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = list(range(len(found)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, s) in enumerate(found):
        for j in {j for x in s for j in holders[x] if j < i}:
            if jaccard_at_least(s, found[j][1]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    out = []
    for i, (place, _) in enumerate(found):
        low = found[root(i)][0]
        gone = low[:2] != place[:2] or low[2] + run <= place[2]
        out.append((place[0], place[2], low[0], low[2], gone and root(i) != i))
    return sorted(out, key=str)


def lines_left(rows, judged):
    """The texts without the lines judged to go; doc_ids are distinct."""
    gone = {(doc, line) for doc, line, _, removed in judged if removed}
    out = []
    for doc, text in rows:
        if text is not None and any(d == doc for d, _ in gone):
            text = "\n".join(l for k, l in enumerate(text.split("\n")) if (doc, k) not in gone)
        out.append((doc, text))
    return out


def bytes_moved(df):
    """Bytes of rows that the shuffles of a plan have dealt out; the plan has run."""
    plans, total = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif name != "ReusedExchangeExec":
            if name == "ShuffleExchangeExec":
                total += plan.metrics().apply("dataSize").value()
            children = plan.children()
            plans += [children.apply(k) for k in range(children.size())]
    return total
