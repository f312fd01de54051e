"""Plain phrase collocations, for small tables."""

import re
from collections import Counter


def collocations(rows, threshold=30, longest=4, top=2000, covered=80):
    """rows: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in f.items() if a >= threshold and len(key[1]) > 1}
    longer = Counter()
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                longer[lang, words[i : i + k]] = max(longer[lang, words[i : i + k]], a)
    best = {}
    for (lang, words), a in found.items():
        if (lang, words) in longer and 100 * longer[lang, words] >= covered * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        best.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, some in best.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out
