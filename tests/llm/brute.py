"""The operators' results by plain loops over small tables: rows of (doc_id, text)."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import xxhash
from public_tokenizers import path
from tokenizers import Tokenizer


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    n = min(3, len(words))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows, bits=3):
    """[(doc_id, fingerprint, component_id)] for rows with a doc_id."""
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return [
        (d, f"{p:016x}", min((x for x in least[find(i)] if x is not None), default=None))
        for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))
    ]


def library(name):
    loaded = Tokenizer.from_file(path(name))
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def encoded(rows):
    tokenizer, found = library("word_bpe_49k.json"), []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        found.append((doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), sha(decoded)))
    return found


def stored_tokens(rows, end_id=2):
    tokenizer, found, start = library("byte_bpe_50k.json"), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        found.append((doc_id, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    return found


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(text):
    return re.sub("[^0-9]", "", text)


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only_digits(m)) <= 15),
}


def base_spans(text):
    found = []
    for rank, (kind, (pattern, valid)) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            if valid(m[0]):
                found.append((m.start(), rank, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def personal(rows):
    found = []
    for doc_id, text in rows:
        spans = base_spans(text)
        counts = [sum(s[0] == kind for s in spans) for kind in BASE]
        found.append((doc_id, *counts, sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    return found


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contaminated(rows, items, size=13, share=20):
    windows = defaultdict(set)
    for item, text in items:
        words = benchmark_words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add("" if item is None else str(item))
    sizes, found = sorted({len(w) for w in windows}), []
    for doc_id, text in rows:
        words, hit, named = benchmark_words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if own := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    named |= own
        dirty = bool(hit) and share * len(hit) >= len(words)
        found.append((doc_id, len(words), len(hit), len(named), sha(",".join(sorted(named))), dirty))
    return found


def exact_duplicates(rows):
    """[(doc_id, keep_id, group_size, kept, sha)]; of repeated rows one is kept."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[sha(text or "")].append(doc_id)
    found = []
    for digest, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for place, doc_id in enumerate(ids):
            found.append((doc_id, keep, len(ids), doc_id == keep and ids.index(doc_id) == place, digest))
    return found


def line_shingles(line, size=5):
    return frozenset(line[i : i + size] for i in range(max(1, len(line) - size + 1)))


def dropped_lines(rows):
    """{doc_id: numbers of the lines that go}; doc_ids are distinct and not null."""
    places = defaultdict(list)
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r").lower()
            if line:
                places[line].append((doc_id, n))
    keys = list(places)
    sets, of = [line_shingles(k) for k in keys], defaultdict(list)
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in enumerate(sets):
        common = defaultdict(int)
        for s in own:
            for j in of[s]:
                common[j] += 1
            of[s].append(i)
        for j, n in common.items():
            if 5 * n >= 4 * (len(own) + len(sets[j]) - n):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, k in enumerate(keys):
        groups[find(i)] += places[k]
    gone = defaultdict(list)
    for members in groups.values():
        for doc_id, n in sorted(members)[1:]:
            gone[doc_id].append(n)
    return {d: sorted(ns) for d, ns in gone.items()}


def licence_paragraphs(text, cues):
    """Paragraphs with a cue: lines that do not end a sentence go on in the next."""
    found, own = [], ""
    for line in re.split("[\r\n]", (text or "").lower().replace("\r\n", "\n")):
        line = line.strip(" \t")
        if own and line and own[-1] not in ".!?:;":
            own += " " + line
        else:
            found.append(own)
            own = line
    found.append(own)
    return [p for p in found if any(c in p for c in cues)]


def licence_likeness(paragraph, templates, words):
    """{family: the largest share of word pairs in common with one of its templates}."""
    own, best = set(zip(words(paragraph), words(paragraph)[1:])), {}
    for family, texts in templates.items():
        for text in texts:
            pairs = set(zip(words(text), words(text)[1:]))
            common = len(own & pairs)
            if common:
                share = max(common / len(pairs), common / len(own) if len(own) >= 3 else 0.0)
                best[family] = max(best.get(family, 0.0), share)
    return best
