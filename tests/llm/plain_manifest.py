"""A plain Merkle manifest, for small tables."""

import hashlib
import zlib


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """Root, and per node the (left, right) siblings of each level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, owned = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for j in range(len(run)):
                for i in owners[a + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha(*run))
            owned.append([i for o in owners[a : a + 8] for i in o])
        nodes, owners = up, owned
    return (nodes[0] if nodes else None), paths


def manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        langs[lang].sort(key=lambda x: x[:3])
        trees.append(tree([x[2] for x in langs[lang]]))
    root, upper = tree([t[0] for t in trees])
    out = []
    for k, lang in enumerate(order):
        for (_, _, digest, row), path in zip(langs[lang], trees[k][1], strict=True):
            path = path + upper[k]
            doc_id, text = row[0], row[4]
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            own = leaf(*row[:4], text)
            for left, right in path:
                own = sha(left, own, right)
            out.append((doc_id, digest, trees[k][0], root, sha(*(a + b for a, b in path)), own, own == root))
    return out
