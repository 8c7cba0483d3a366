"""Conversation repair by plain dynamic programming over whole strings, for comparison."""

import hashlib
import zlib
from functools import lru_cache

WS = " \t\n\x0b\x0c\r"
# state: 0 start, 1 after s, 2 open u (after start, s or a pair), 3 after a pair
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {"u": "user", "a": "assistant"}


def damage(rows):
    """rows of one conversation (conv, turn, role, text) -> after damage, by turn."""
    out = []
    for conv, turn, role, text in rows:
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if n == 0:
            continue
        text = "" if n == 1 else "".join(c for c in text if c not in ".!?") if n == 2 else text
        out += [(turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(WS)
        out.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repair(rows, fault):
    n = len(rows)

    @lru_cache(None)
    def best(i, state, inserted):
        """(cost, audit, turns) of the rest; at most three inserts in a row."""
        found = [(0, "", ())] if i == n and state in (0, 3) else []
        if inserted < 3:
            for t, role in ROLE.items():
                if (state, t) in MOVES:
                    rest = best(i, MOVES[state, t], inserted + 1)
                    if rest:
                        found.append((rest[0] + 5, "I" + rest[1], (f"{role}:", *rest[2])))
        if i < n:
            _, role, text = rows[i]
            rest = best(i + 1, state, 0)
            if rest:
                found.append((rest[0] + 2, "D" + rest[1], rest[2]))
            if fault[i] not in ("b", "d"):
                late = 5 if fault[i] == "t" else 0
                for letter, t, name, cost in [("K", role[:1], role, 0), ("R", "u", "user", 1), ("R", "a", "assistant", 1)]:
                    if (state, t) in MOVES:
                        rest = best(i + 1, MOVES[state, t], 0)
                        if rest:
                            found.append((rest[0] + cost + late, letter + rest[1], (f"{name}:{text}", *rest[2])))
        return min(found, key=lambda x: x[:2], default=None)

    return best(0, 0, 0)


def expected(all_rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)}"""
    by = {}
    for r in all_rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for conv, own in by.items():
        rows = damage(own)
        fault = faults(rows)
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, text = repair(rows, fault)
        out[conv] = gaps, fault.count("b"), fault.count("d"), fault.count("t"), bad, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()
    return out
