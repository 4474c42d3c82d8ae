"""Plain definitions of what the operators compute, over a few small texts."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

from pyspark.sql.types import LongType, StringType, StructField, StructType

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Names that operators use for themselves.
CLASHING = (
    "ids n_tokens kept hits rules quality row parts spans set key label n band labels node root version base found "
    "token pattern score shard start place windows copies links work content"
).split()

PASSAGE = " ".join(f"w{i}é" for i in range(40))
TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "One two  three\nfour. FIVE's 12 漢字 😀 six",
    PASSAGE,
    "Before it. " + PASSAGE + "\nAfter it, more words stand here.",
    PASSAGE.replace("w20é", "other"),
    ("again and again the same line\n" * 30) + "end",
    "x" * 70_000 + " " + "y1! " * 20_000,
    " ".join(f"v{i % 97}" for i in range(3000)),
]
ROWS = [(i, text) for i, text in enumerate(TEXTS)] + [(4, TEXTS[4]), (20, PASSAGE), (None, PASSAGE), (21, TEXTS[8])]


def documents(spark, rows=ROWS):
    """The rows with further columns whose names clash with those that operators use."""
    shape = StructType([StructField("doc_id", LongType()), StructField("text", StringType())] + [StructField(c, StringType()) for c in CLASHING])
    return spark.createDataFrame([(*row, *(c for c in CLASHING)) for row in rows], shape).repartition(3)


def words(text, pattern=SPACED):
    return pattern.findall(text or "")


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def window_hits(text, items, size=13):
    """(words, hit words, items with a window in it)."""
    own = words(lower_az(text), LETTERS)
    hit, found = set(), set()
    for name, item in items:
        theirs = words(lower_az(item), LETTERS)
        n = min(size, len(theirs))
        phrases = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i : i + n]) in phrases:
                hit.update(range(i, i + n))
                found.add(name)
    return len(own), len(hit), found


def without_repeats(rows, size=20):
    """Per row (key, words, removed, kept text); rows of equal key are one document."""
    first = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        own = words(rows[i][1])
        for j in range(len(own) - size + 1):
            place = (rows[i][0] is not None, rows[i][0] or 0, j)
            window = tuple(own[j : j + size])
            first[window] = min(first.get(window, place), place)
    out = []
    for key, text in rows:
        own, gone = words(text), set()
        for j in range(len(own) - size + 1):
            if first[tuple(own[j : j + size])] != (key is not None, key or 0, j):
                gone.update(range(j, j + size))
        out.append((key, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return out


def shingle_set(text, size=5):
    own = words(text)
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def similar_classes(rows, numerator=4, denominator=5):
    """Per row (key, class, links)."""
    sets = [shingle_set(text) for _, text in rows]
    near = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and denominator * len(a & b) >= numerator * len(a | b):
                near[i].add(j)
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((key, min(keys, default=None), len(near[i])))
    return out


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    own = words(text)
    lines = [line for line in (text or "").split("\n") if SPACED.search(line)]
    windows = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    covered = {j for i in range(len(own) - 7) if windows[tuple(own[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered)


def kneser_ney(train, texts):
    """Per text (tokens, known, base score, score) under a bigram model of the texts to train on."""

    def tokens(text):
        return words(lower_az(text)) + ["</s>"]

    counts, pairs = Counter(), Counter()
    for text in train:
        own = tokens(text)
        counts.update(own)
        pairs.update(zip(["</s>", *own], own))
    total, different = sum(counts.values()), len(counts)
    after, before = defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (a, b), c in pairs.items():
        after[a][min(c, 3)] += 1
        before[b] += 1

    def discount(values):
        n = Counter(values)
        plain = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        rule = lambda i: min(max(i - (i + 1) * plain * n[i + 1] / n[i], 0), i) if n[i] and n[i + 1] else 0.5 * i
        return [0, rule(1), rule(2), rule(3)]

    d, e = discount(pairs.values()), discount(before.values())
    rest = sum(e[min(c, 3)] for c in before.values()) / len(pairs)
    out = []
    for text in texts:
        own = tokens(text)
        score = base = 0.0
        for a, b in zip(["</s>", *own], own):
            low = max(before[b] - e[min(before[b], 3)], 0) / len(pairs) + rest / (different + 1)
            c, n = pairs[a, b], counts[a]
            back = sum(d[i] * after[a][i] for i in (1, 2, 3))
            score += math.log10(low if not n else max(c - d[min(c, 3)], 0) / n + back / n * low)
            base += math.log10((counts[b] + 1) / (total + different + 1))
        out.append((len(own), sum(counts[w] > 0 for w in own), base, score))
    return out


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def secrets(text):
    """Base spans (start, order, kind, end), sorted."""
    out = []
    pattern = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(pattern, text or "", re.ASCII):
        out += [(m.start(), 0, "assign", m.end())] * (len(m[2]) >= 8)
    for m in re.finditer("AKIA[A-Z0-9]+", text or ""):
        out += [(m.start(), 1, "access", m.end())] * (len(m[0]) >= 16)
    for m in re.finditer("[0-9a-f]+", text or ""):
        out += [(m.start(), 2, "hex", m.end())] * (len(m[0]) >= 32)
    return sorted(out)


def personal(text):
    """Base spans (start, order, kind, end), sorted."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text or ""):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text or ""):
        out += [(m.start(), 1, "ip", m.end())] * all(int(x) <= 255 for x in m[0].split("."))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text or ""):
        number = re.sub("[^0-9]", "", m[0])
        out += [(m.start(), 2, "card", m.end())] * (14 <= len(number) <= 19 and luhn(number))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text or ""):
        out += [(m.start(), 3, "phone", m.end())] * (10 <= len(re.sub("[^0-9]", "", m[0])) <= 15)
    return sorted(out)


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def collocations(given, longest=4, least=30, within=80, rows=2000):
    """``lang, rank, phrase, a, l, r, n, score`` of the given (text, lang) pairs."""
    counts, totals = Counter(), Counter()
    for text, lang in given:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_az(text)):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for n in range(1, longest + 1):
                counts.update((lang, tuple(found[i : i + n])) for i in range(len(found) - n + 1))
    best = {}
    for (lang, phrase), a in counts.items():
        if len(phrase) > 1 and a >= least:
            cuts = []
            for k in range(1, len(phrase)):
                left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            best[lang, phrase] = (a, *min(cuts))
    kept = []
    for (lang, phrase), (a, score, _, left, right) in best.items():
        inside = any(
            of == lang and len(longer) > len(phrase) and 100 * row[0] >= within * a
            and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer)))
            for (of, longer), row in best.items()
        )
        if not inside:
            kept.append((lang, -score, -a, " ".join(phrase).encode(), left, right))
    result, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(kept):
        rank[lang] += 1
        if rank[lang] <= rows:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def url_parts(url):
    """(host, path) of a url."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower_az(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def url_rule(host, path, rules):
    """(rule, verdict) of the longest rule that fits."""
    fits = []
    for verdict, rule in rules:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def url_segments(path, depth=6):
    every = path.split("/")[1:]
    masked = []
    for s in every[:depth]:
        if re.fullmatch("[0-9]+", s):
            masked.append("#")
        elif re.fullmatch("[0-9A-Fa-f-]{8,}", s) and re.search("[0-9]", s):
            masked.append("<hex>")
        else:
            masked.append(re.sub("[0-9]+", "#", s))
    return tuple(masked + ["<deep>"] * (len(every) > depth))


def url_templates(labelled, wide=16, rare=2, tolerance=0.02):
    """{(host, segments): template} of (host, segments, label) rows."""

    def kind(s):
        return 0 if s is None else 1 if s == "" else 2 if s == "#" else 4 if s == "<hex>" else 5 if "." in s else 3 if "#" in s else 6

    def apart(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        return sum((a * math.log(2 * a / (a + b)) if a else 0) + (b * math.log(2 * b / (a + b)) if b else 0) for a, b in zip(p, q)) / 2

    paths = {(host, segments): "" for host, segments, _ in labelled}
    for level in range(max((len(s) for _, s in paths), default=0)):
        children = defaultdict(lambda: [0, [0] * 7, [0] * 3])
        for host, segments, label in labelled:
            if len(segments) > level:
                child = children[host, paths[host, segments], segments[level]]
                child[0] += 1
                child[1][kind(segments[level + 1] if len(segments) > level + 1 else None)] += 1
                child[2][{"block": 0, "allow": 1, None: 2}[label]] += 1
        nodes, names, groups = defaultdict(list), {}, defaultdict(list)
        for place, child in children.items():
            nodes[place[:2]].append(child[0])
        for place, (n, after, labels) in children.items():
            kids = nodes[place[:2]]
            if len(kids) >= wide and n * len(kids) <= rare * sum(kids):
                names[place] = "*"
            else:
                groups[(*place[:2], after.index(max(after)), labels.index(max(labels)))].append(place)
        for places in groups.values():
            pool = [[sum(children[p][i][j] for p in places) for j in range(size)] for i, size in ((1, 7), (2, 3))]
            near = [
                p for p in places
                if all(apart(children[p][i], pool[i - 1]) <= tolerance + (size - 1) / (8 * children[p][0]) for i, size in ((1, 7), (2, 3)))
            ]
            if len(near) > 1:
                names |= {p: "{" + min(x[2] for x in near) + ",…}" for p in near}
        for (host, segments), template in paths.items():
            if len(segments) > level:
                paths[host, segments] = f"{template}/{names.get((host, template, segments[level]), segments[level])}"
    return paths


def url_verdicts(rows, rules):
    """(key, host, path, rule, verdict) of (key, url) rows."""
    parsed = [(key, *url_parts(url)) for key, url in rows]
    ruled = [(key, host, path, *url_rule(host, path, rules)) for key, host, path in parsed]
    labelled = [(host, url_segments(path), verdict) for _, host, path, _, verdict in ruled]
    paths, counts = url_templates(labelled), defaultdict(Counter)
    for host, segments, label in labelled:
        counts[host, paths[host, segments]][label] += 1
    result = []
    for (key, host, path, rule, verdict), (_, segments, _) in zip(ruled, labelled):
        here = counts[host, paths[host, segments]]
        bad = (here["block"] + 1) / (here["block"] + here["allow"] + 2) >= 0.8
        result.append((key, host, path, rule, verdict or ("block" if bad else "allow")))
    return result
