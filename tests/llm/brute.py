"""Plain versions of the operators, for small fixtures."""

import hashlib
import math
import re

ASSIGN = re.compile(
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def entropy_peak(value, window):
    best = 0.0
    for i in range(len(value) - window + 1):
        part = value[i : i + window]
        best = max(best, -sum(part.count(c) / window * math.log2(part.count(c) / window) for c in set(part)))
    return best


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
