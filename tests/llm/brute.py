"""Plain versions of the operators, one row or pair at a time, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import xxhash


def lower_ascii(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(items, linked):
    """Smallest member of each item's component, by a search over all pairs."""
    left, of = set(range(len(items))), {}
    while left:
        todo, found = [left.pop()], set()
        while todo:
            i = todo.pop()
            found.add(i)
            near = {j for j in left if linked(items[i], items[j])}
            left -= near
            todo += near
        for i in found:
            of[i] = found
    return of


def near_duplicates(rows, radius=2):
    """rows: (doc_id, text) -> (doc_id, fingerprint, component_id)."""
    prints = [simhash(t) for _, t in rows]
    of = groups(prints, lambda a, b: (a ^ b).bit_count() <= radius)
    return sorted((rows[i][0], f"{prints[i]:016x}", min(rows[j][0] for j in of[i])) for i in range(len(rows)))


def remove_repeats(rows, n=200):
    """rows: (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    raw = [(t or "").encode() for _, t in rows]
    count = defaultdict(int)
    for r in raw:
        for i in range(len(r) - n + 1):
            count[r[i:i + n]] += 1
    out = []
    for (d, _), r in zip(rows, raw):
        gone = bytearray(len(r))
        for i in range(len(r) - n + 1):
            if count[r[i:i + n]] > 1:
                gone[i:i + n] = b"\x01" * n
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((d, len(r), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def words7(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def contamination(rows, items, w=10):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    wins = defaultdict(set)
    for item, text in items:
        ws = words7(text)
        for win in [tuple(ws[i:i + w]) for i in range(len(ws) - w + 1)] if len(ws) > w else [tuple(ws)] if ws else []:
            wins[win].add(str(item))
    sizes = {len(x) for x in wins}
    out = []
    for d, text in rows:
        ws = words7(text)
        hit, found = [False] * len(ws), set()
        for size in sizes:
            for i in range(len(ws) - size + 1):
                if (x := tuple(ws[i:i + size])) in wins:
                    hit[i:i + size] = [True] * size
                    found |= wins[x]
        out.append((d, len(ws), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)))
    return sorted(out)


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        v = int(c)
        if k % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def personal(text):
    """Base spans by the patterns as stated: (kind, start, end)."""
    t = text or ""

    def digits(m):
        return re.sub(r"[^0-9]", "", m[0])

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]
    return out


def token_rows(rows, tokenizer):
    """(doc_id, start, n_tokens, ids_crc32) in ascending order of doc_id."""
    at, out = 0, []
    for d, t in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    return out


def dropout_encode(text, salt, sp, dropout, kept):
    """Merge the best pair of the whole text again and again; ``kept(start, end)`` says if a candidate escapes."""
    if not text:
        return []
    piece = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    sym = [(" " if c == " " else c, i, i + 1) for i, c in enumerate(" " + text)]
    sym = [("▁" if c == " " else "\0" + c if c == "▁" else c, a, b) for c, a, b in sym]
    while True:
        best = None
        for i in range(len(sym) - 1):
            joined = sym[i][0] + sym[i + 1][0]
            if joined in piece and kept(sym[i][1], sym[i + 1][2]):
                rank = (-sp.get_score(piece[joined]), i)
                best = min(best, rank) if best else rank
        if best is None:
            break
        i = best[1]
        sym[i:i + 2] = [(sym[i][0] + sym[i + 1][0], sym[i][1], sym[i + 1][2])]
    out = []
    for s, _, _ in sym:
        if s in piece:
            out.append(piece[s])
        else:
            out += [sp.piece_to_id(f"<0x{b:02X}>") for b in (s[1:] if s == "\0▁" else s).encode()]
    return out
