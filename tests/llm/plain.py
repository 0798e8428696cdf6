"""Plain loops that say what the operators must return."""

import hashlib
import re
from collections import Counter

import xxhash

WHITE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = str.maketrans(UPPER, UPPER.lower())


def simhash(text):
    words = WHITE_WORD.findall((text or "").translate(LOWERED))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows):
    """``[(doc_id, fingerprint, component_id)]`` of ``[(doc_id, text)]``, ids not null."""
    prints = [simhash(t) for _, t in rows]
    least = [d for d, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if least[j] < least[i] and (prints[i] ^ prints[j]).bit_count() <= 2:
                    least[i], changed = least[j], True
    return [(d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, least)]


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))


def contamination(documents, benchmark):
    items = {}
    for item, text in benchmark:
        words = benchmark_words(text)
        size = min(13, len(words))
        for s in range(len(words) - size + 1 if words else 0):
            items.setdefault(tuple(words[s : s + size]), set()).add(item)
    sizes = {len(w) for w in items}
    out = []
    for doc, text in documents:
        words = benchmark_words(text)
        hit, found = set(), set()
        for size in sizes:
            for s in range(len(words) - size + 1):
                if owners := items.get(tuple(words[s : s + size])):
                    hit.update(range(s, s + size))
                    found |= owners
        listed = ",".join(sorted(str(i) for i in found if i is not None))
        out.append(
            (doc, len(words), len(hit), len(found - {None}), hashlib.sha256(listed.encode()).hexdigest(),
             bool(hit) and 20 * len(hit) >= len(words))
        )
    return out


def quality(text):
    text = text or ""
    words = WHITE_WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WHITE_WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def quality_kept(text):
    words, chars, symbols, lines, repeats = quality(text)
    capitals = len(re.findall("[A-Z]", text or ""))
    return not (
        words < 50 or 100 * repeats > 50 * words or 10 * symbols > 4 * words or 2 * capitals > chars
        or 5 * lines > words or chars < 2 * words or chars > 20 * words
    )


BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal_data(text):
    """Counts of the kinds and the joined base spans."""
    spans = []
    for place, (kind, pattern) in enumerate(BASE_PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits))]
            valid = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if valid:
                spans.append((m.start(), place, kind, m.end()))
    spans.sort()
    counts = Counter(s[2] for s in spans)
    joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
    return tuple(counts[k] for k in BASE_PATTERNS), joined


def mix_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by sharing what is over again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def judged(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOWERED), m[2]) if m else ("", "")
    fits = [h + p for h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def repaired(rows):
    """``{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)}`` of ``[(conv, turn, role, text)]``.

    Tries all edits at every row and keeps whole texts of edits for each state.
    """
    conversations = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, []).append((turn is not None, turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, listed in conversations.items():
        listed.sort(key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in listed:
            end = text.rstrip(" \t\n\x0b\f\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            faults.append(fault)
            seen.add((role, text))

        def legal(said):
            return re.fullmatch(r"s?(ua)*u?", said) is not None

        ways = {"": (0, "", ())}  # the last two letters said, by which all is decided
        for (_, _, role, text), fault in zip(listed, faults):
            more = {}

            def offer(said, way):
                key = said[-1:]
                if key not in more or way < more[key]:
                    more[key] = way

            for said, (cost, audit, kept) in ways.items():
                for gap in ("", "u", "a", "ua", "au"):
                    now = said + gap
                    if not (legal(now) or legal("u" + now) if said == "a" else legal(now)):
                        continue
                    names = tuple(({"u": "user", "a": "assistant"}[g], "") for g in gap)
                    way = cost + 5 * len(gap), audit + "I" * len(gap), kept + names
                    offer(now, (way[0] + 2, way[1] + "D", way[2]))
                    if fault in ("blank", "duplicate"):
                        continue
                    late = 5 if fault else 0
                    for edit, name, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                        then = now[-1:] + name[:1] if now else name[:1]
                        if name and then in ("s", "u", "su", "ua", "au"):
                            offer(then, (way[0] + late + price, way[1] + edit, way[2] + ((name, text),)))
            ways = more
        ends = []
        for said, (cost, audit, kept) in ways.items():
            if said in ("", "a"):
                ends.append((cost, audit, kept))
            elif said == "u":
                ends.append((cost + 5, audit + "I", (*kept, ("assistant", ""))))
            else:
                ends.append((cost + 10, audit + "II", (*kept, ("user", ""), ("assistant", ""))))
        cost, audit, kept = min(ends)
        turns = {t for _, t, _, _ in listed if t is not None}
        letters = [r[2][:1] for r in listed]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(letters, letters[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        )
    return out


def ranked(documents, items, size=10):
    """``[(item_id, rank, doc_id, score)]`` by scoring every document for every item."""
    import math

    cut = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))
    held = [(d, Counter(cut(t))) for d, t in documents]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    total, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, counts, n in held:
            m = 10 + (90 * n * total) // length
            score = 0
            for t in set(cut(text)):
                if tf := counts[t]:
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(found)[:size], 1):
            out.append((item, rank, None if none else doc, -score))
    return out


def components(count, pairs):
    """``{node: least node it is connected to}``."""
    least = list(range(count))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        least[b] = a
    return {k: find(k) for k in range(count)}


def templates(rows, depth, variable, distance, prior):
    """``(template, rate, labels)`` of every ``(host, path, label)``, grown level by level."""

    def counted(ks):
        return sum(rows[k][2] == 0 for k in ks), sum(rows[k][2] == 1 for k in ks)

    def smoothed(ks, parent):
        allow, block = counted(ks)
        return (block + prior * parent) / (allow + block + prior) if allow + block else overall

    def by_template(at):
        groups = {}
        for k, template in at.items():
            groups.setdefault(template, []).append(k)
        return groups

    allow, block = counted(range(len(rows)))
    overall = block / (allow + block) if allow + block else 0.0
    segments = [[s for s in path.split("/") if s] + ["$"] for _, path, _ in rows]
    at = {k: host for k, (host, _, _) in enumerate(rows)}
    rate = {host: smoothed(ks, overall) for host, ks in by_template(at).items()}
    found, level = {}, 0
    while at:
        following = {}
        for template, ks in by_template(at).items():
            allow, block = counted(ks)
            branches = {}
            for k in ks:
                if level >= depth and not (allow and block) and len(segments[k]) > level + 1:
                    segments[k] = segments[k][:level] + ["**"]
                own = segments[k][level]
                branches.setdefault("*" if re.search(variable, own) else own, []).append(k)
            for own, members in branches.items():
                a, b = counted(members)
                n, rest = a + b, allow + block - a - b
                apart = False
                if n and rest:
                    pooled = block / (n + rest)
                    error = (pooled * (1 - pooled) * (1 / n + 1 / rest)) ** 0.5
                    apart = abs(b / n - (block - b) / rest) > distance * error
                named = own != "*" and (own in ("$", "**") or apart)
                following |= {k: f"{template}/{own if named else '*'}" for k in members}
        for template, ks in by_template(following).items():
            rate[template] = smoothed(ks, rate[template.rsplit("/", 1)[0]])
            for k in ks:
                if len(segments[k]) == level + 1:
                    found[k] = (template, rate[template], sum(counted(ks)))
        level += 1
        at = {k: t for k, t in following.items() if k not in found}
    return [found[k] for k in range(len(rows))]
