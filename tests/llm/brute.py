"""Plain versions of the operators' rules, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
import xxhash

from footfall.llm import quality

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def white_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def decontaminated(documents: list[tuple], benchmark: list[tuple]) -> list[tuple]:
    windows: dict[tuple, set[str]] = {}
    for item, text in benchmark:
        words = alnum_words(text)
        n = min(13, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            named = windows.setdefault(tuple(words[k : k + n]), set())
            if item is not None:
                named.add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in documents:
        words = alnum_words(text)
        hit, items = [False] * len(words), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                found = windows.get(tuple(words[k : k + n]))
                if found is not None:
                    items |= found
                    hit[k : k + n] = [True] * n
        listed = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        bad = sum(hit) > 0 and 20 * sum(hit) >= len(words)
        out.append((doc, len(words), sum(hit), len(items), listed, bad))
    return out


def components(nodes: list, linked) -> dict:
    """Smallest node reachable, by comparing all pairs."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def simhash(text: str | None) -> int:
    words = white_words(text)
    n = min(3, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[k : k + n]).encode(), 42)
        for k in range(len(words) - n + 1 if n else 0)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(documents: list[tuple]) -> list[tuple]:
    prints = {doc: simhash(text) for doc, text in documents}
    tied = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    return [(doc, f"{prints[doc]:016x}", tied[doc]) for doc, _ in documents]


def piece_ids(documents: list[tuple], model_path: str) -> list[tuple]:
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
    out = []
    for doc, text in documents:
        ids = lib.encode(text or "")
        listed, decoded = ",".join(map(str, ids)).encode(), lib.decode(ids).encode()
        out.append(
            (doc, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded).hexdigest())
        )
    return out


def token_ids(documents: list[tuple], tokenizer_path: str) -> list[tuple]:
    from tokenizers import Tokenizer

    lib, start, out = Tokenizer.from_file(tokenizer_path), 0, []
    for doc, text in sorted(documents):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((doc, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    return out


def votes(model, texts: list[str]) -> list[float]:
    """Quality scores from the model's vectors, one text and one neighbour at a time."""
    out = []
    for text in texts:
        place = model.place(quality.rows_of_terms(pa.array([text])))[0].astype(float)
        near = []
        for k, vector in enumerate(model.vectors.astype(float)):
            near.append((-sum(x * y for x, y in zip(place, vector, strict=True)), k))
        near = sorted(near)[: quality.NEIGHBOURS]
        weights = [max(-c, 1e-6) ** quality.SHARPNESS for c, _ in near]
        good = sum(w for w, (_, k) in zip(weights, near, strict=True) if model.labels[k])
        out.append(good / sum(weights))
    return out
