"""SQL fragments of the oracle side, written independently of the Spark expressions."""

from __future__ import annotations

from scanloom.plans.derived import ATTRIBUTES


def uuid_hex(x: str) -> str:
    h = f"md5({x})"
    return f"(substr({h}, 1, 12) || '3' || substr({h}, 14, 3) || translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 15))"


def uuid_text(x: str) -> str:
    h = uuid_hex(x)
    return f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12))"


def remapped(x: str) -> str:
    h = uuid_hex(x)
    return (f"('2.25.' || CAST(CAST(('0x' || substr({h}, 1, 16))::UBIGINT AS UHUGEINT) * 18446744073709551616::UHUGEINT + ('0x' || substr({h}, 17, 16))::UBIGINT AS STRING))")


def shifted(da: str, days: str) -> str:
    """Eight-digit date moved by days; NULL when it is none."""
    return f"strftime(CAST(try_strptime({da}, '%Y%m%d') AS DATE) + CAST({days} AS INT), '%Y%m%d')"


def blank(x: str) -> str:
    return f"(trim(coalesce({x}, '')) = '')"


def nested_document(entry, opened, closed, separator: str, skip=lambda tag, path: False) -> str:
    """Concatenation of attribute texts in tag order, sequences filled recursively."""
    def level(path) -> str:
        parts = []
        rows = sorted((a for a in ATTRIBUTES if [p for p in a[0]] == path), key=lambda a: a[1])
        for p, tag, keyword, vr, value, cond in rows:
            if skip(tag, p):
                continue
            if vr == "SQ":
                inner = level([*path, (tag, keyword, 0)])
                body = f"CASE WHEN {inner} <> '' THEN {opened(inner)} ELSE {closed} END"
                text = f"{entry(tag, keyword, vr, None)} || {body}"
            else:
                text = entry(tag, keyword, vr, value)
            parts.append(f"CASE WHEN {cond} THEN '{separator}' || {text} ELSE '' END")
        return "(" + (" || ".join(parts) or "''") + ")"

    return level([])
