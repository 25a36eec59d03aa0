"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def words(text):
    return WORD.findall(text or "")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def passages(rows, width=20):
    """(doc_id, text) rows to (n_words, n_removed, kept_sha256) each; null ids come first."""
    key = lambda doc: (doc is not None, doc)
    first = {}
    for doc, text in rows:
        own = words(text)
        for start in range(len(own) - width + 1):
            window = tuple(own[start:start + width])
            place = (key(doc), start)
            if window not in first or place < first[window]:
                first[window] = place
    out = []
    for doc, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for start in range(len(own) - width + 1):
            if first[tuple(own[start:start + width])] < (key(doc), start):
                gone[start:start + width] = [True] * width
        out.append((len(own), sum(gone), sha(" ".join(w for w, g in zip(own, gone) if not g))))
    return out


def byte_passages(rows, width=400):
    """(doc_id, text) rows to (n_bytes, n_removed, n_spans, kept_sha256) each."""
    places = defaultdict(set)
    for doc, text in rows:
        data = (text or "").encode()
        for start in range(len(data) - width + 1):
            places[data[start:start + width]].add((doc, start))
    out = []
    for _, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for start in range(len(data) - width + 1):
            if len(places[data[start:start + width]]) > 1:
                gone[start:start + width] = b"\x01" * width
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(data), sum(gone), spans, sha(kept)))
    return out


def shingles(text, width=5):
    own = words((text or "").translate(LOWER))
    if len(own) < width:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[k:k + width]) for k in range(len(own) - width + 1))


def components(rows, percent=85):
    """{doc_id: (n_shingles, component_id, kept)} by comparing all pairs."""
    found = [(doc, shingles(text)) for doc, text in rows]
    parent = {doc: doc for doc, _ in found}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, left) in enumerate(found):
        for b, right in found[:k]:
            common = len(left & right)
            if common and 100 * common >= percent * (len(left) + len(right) - common):
                x, y = root(a), root(b)
                parent[max(x, y, key=_order)] = min(x, y, key=_order)
    return {doc: (len(own), root(doc), root(doc) == doc) for doc, own in found}


def _order(doc):
    return (doc is not None, doc)


def measures(text):
    text = text or ""
    own = words(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = Counter(zip(own, own[1:], own[2:]))
    covered = set()
    for k in range(len(own) - 2):
        if grams[tuple(own[k:k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    repeat = len(covered)
    return (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
            len(own) < 50 or 100 * repeat > 50 * len(own))


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    total = 0
    for k, digit in enumerate(map(int, reversed(digits))):
        total += digit if k % 2 == 0 else sum(divmod(2 * digit, 10))
    return total % 10 == 0


def personal(text):
    """Base spans as (start, kind, end)."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found)


LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def vocabulary(rows, least_length=6, least_count=5, slip=199):
    """(doc_id, text) rows to {word: count}."""
    counts = Counter()
    for doc, text in rows:
        for run in LETTERS.findall(text or ""):
            word = run.translate(LOWER)
            check = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if check % slip == 0:
                place = check % len(word)
                word = word[:place] + word[place + 1:]
            counts[word] += 1
    return {word: n for word, n in counts.items() if len(word) >= least_length and n >= least_count}


def variants(counts, ratio=5):
    """{word: count} to rows (word, form, root, n, n_near, form_n), by patterns with one hole."""
    holes, near = defaultdict(set), {word: set() for word in counts}
    for word in counts:
        for k in range(len(word)):
            holes[word[:k] + "\0" + word[k + 1:]].add(word)
            shorter = word[:k] + word[k + 1:]
            if shorter in counts:
                near[word].add(shorter)
                near[shorter].add(word)
    for some in holes.values():
        for word in some:
            near[word] |= some - {word}
    form = {}
    for word, some in near.items():
        best = min(some, key=lambda one: (-counts[one], one), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] else None
    out = []
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return sorted(out)


def vector_links(rows, cosine=0.9):
    """(vec_id, vector) rows to (vec_id, n_links, component_id, kept) each; a null id counts as the smallest."""
    valid = [vector is not None and all(x is not None and math.isfinite(x) for x in vector) and any(vector)
             for _, vector in rows]
    dims = max((len(vector) for _, vector in rows if vector is not None), default=0)
    padded = [list(vector) + [0.0] * (dims - len(vector)) if ok else None for (_, vector), ok in zip(rows, valid)]
    links = [set() for _ in rows]
    for i, left in enumerate(padded):
        for j, right in enumerate(padded[:i]):
            if left is not None and right is not None:
                scale = max(map(abs, left)), max(map(abs, right))
                a, b = [x / scale[0] for x in left], [x / scale[1] for x in right]
                if math.fsum(x * y for x, y in zip(a, b)) / (math.hypot(*a) * math.hypot(*b)) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i, (vec, _) in enumerate(rows):
        seen, open_ = {i}, [i]
        while open_:
            fresh = links[open_.pop()] - seen
            seen |= fresh
            open_ += fresh
        least = min((rows[k][0] for k in seen), key=_order)
        out.append((vec, len(links[i]), least, vec == least))
    return out


def filter_masks(rows):
    """(doc_id, part, text) rows to the letters of the filters that each fails."""
    out = []
    for doc, _, text in rows:
        text = text or ""
        own = words(text)
        copies = [other for other, _, same in rows if (same or "") == text and _order(other) < _order(doc)]
        fails = [len(own) < 100, 100 * len(set(own)) < 80 * len(own),
                 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text)), bool(copies)]
        out.append("".join(letter for letter, bad in zip("ABCDE", fails) if bad))
    return out


def filter_audit(rows, quality, toxic):
    """Rows (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), by applying
    the filters to the documents in every order; ``quality`` and ``toxic`` hold the ids labelled 1."""
    masks, out = filter_masks(rows), []
    for part in {part or "" for _, part, _ in rows}:
        own = [(doc, bad) for (doc, p, _), bad in zip(rows, masks) if (p or "") == part]
        found, removed_by = [], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [doc for doc, bad in left if letter in bad]
                left = [(doc, bad) for doc, bad in left if letter not in bad]
                removed_by[letter] += len(removed)
                fails = sum(letter in bad for _, bad in own)
                found.append((letter, (part, order, step, len(left), len(removed), fails - len(removed),
                                       sum(bad == letter for _, bad in own), sum(doc in quality for doc in removed),
                                       sum(doc in toxic for doc in removed))))
        out += [(*row, removed_by[letter]) for letter, row in found]
    return sorted(out)


def mixture(sizes, evenness, max_repeats):
    """{source: tokens} to ({source: passes}, exponent), the exponent found in small steps."""
    held = {name: size for name, size in sizes.items() if size}

    def at(exponent):
        raised = {name: size ** exponent for name, size in held.items()}
        whole = sum(raised.values())
        weights = {name: one / whole for name, one in raised.items()}
        passes = {name: weights[name] / size for name, size in held.items()}
        least = min(passes.values())
        return -sum(one * math.log(one) for one in weights.values()), {name: one / least for name, one in passes.items()}

    target = at(1.0)[0] + evenness * (at(0.0)[0] - at(1.0)[0])
    steps = [k / 20_000 for k in range(20_001)]
    fits = [x for x in steps if at(x)[0] >= target]
    exponent = max(max(fits), min(x for x in steps if max(at(x)[1].values()) <= max_repeats))
    return {**at(exponent)[1], **{name: 1.0 for name, size in sizes.items() if not size}}, exponent


def verdicts(rows, labels, alpha=0.02, delta=0.05, price=10.0):
    """(doc_id, stratum, scores of the rules, base_failed) rows and {doc_id: quality} to the kept flag of each row."""
    passed = [row for row in rows if not row[3]]
    count, levels = len(rows[0][2]) if rows else 0, {}
    for stratum in {row[1] for row in passed}:
        own = [row[2] for row in passed if row[1] == stratum]
        for rule in range(count):
            for score in {one[rule] for one in own if one[rule] > 0}:
                share = sum(one[rule] >= score for one in own) / len(own)
                levels[stratum, rule, score] = min(math.floor(-100 * math.log10(share)), 1000)
    held = [row for row in passed if row[0] in labels]
    strata, cut = {row[1] for row in held}, {}

    def joint(row, rules):
        return max((levels.get((row[1], rule, row[2][rule]), 0) for rule in range(rules)), default=0)

    for stratum in strata:
        own = [row for row in held if row[1] == stratum]
        good = [row for row in own if labels[row[0]] == 1]
        bound, best = delta / (count * len(strata)), 0.0
        tail, most = 0.0, -1
        while most < len(good) and tail <= bound:
            most += 1
            tail = math.fsum(math.comb(len(good), j) * alpha ** j * (1 - alpha) ** (len(good) - j) for j in range(most + 1))
        most -= 1
        for rules in range(1, count + 1):
            for level in range(1000, 0, -1):
                false = sum(joint(row, rules) >= level for row in good)
                if false > most:
                    break
                true = sum(joint(row, rules) >= level for row in own) - false
                if true - price * false > best:
                    best, cut[stratum] = true - price * false, (rules, level)
    return [not row[3] and not (row[1] in cut and joint(row, cut[row[1]][0]) >= cut[row[1]][1]) for row in rows]
