"""Statements as written for the embedded database that facts used to live in, in Spark's SQL."""

from __future__ import annotations

import re
from collections.abc import Iterable

_TOKEN = re.compile(r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|\[[^\]]*\]|`[^`]*`|--[^\n]*|/\*.*?\*/|[A-Za-z_]\w*|\d+(?:\.\d*)?|\s+|.""", re.S)
ROW_IDS = {"rowid", "_rowid_", "oid"}
#: Functions of the same arguments under another name.
RENAMED = {"printf": "format_string", "group_concat": "listagg", "char": "chr"}


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _of_glob(pattern: str) -> str:
    """A regular expression for a pattern of *, ? and [...] that must match as a whole."""
    out = []
    for m in re.finditer(r"\*|\?|\[(\^?)([^\]]+)\]|.", pattern, re.S):
        t = m.group()
        out.append(".*" if t == "*" else "." if t == "?" else f"[{m.group(1)}{m.group(2)}]" if m.group(2) else re.escape(t))
    return "(?s)^" + "".join(out) + "$"


def to_spark(sql: str, columns: Iterable[str], row_id: str) -> str:
    """The statement with the other dialect's habits spelled out; texts within quotes and comments stay as they are.

    LIKE ignores case; GLOB is a regular expression; row ids are the column `row_id`, under the name they were asked for; a name in double
    quotes is a column if there is one of that name, else a text; backslashes in texts are plain; some functions have other names.
    """
    known = {c.lower() for c in columns}
    tokens = _TOKEN.findall(sql)
    solid = [i for i, t in enumerate(tokens) if not t.isspace() and not t.startswith(("--", "/*"))]
    after, before = dict(zip(solid, solid[1:])), dict(zip(solid[1:], solid))
    out = list(tokens)
    selecting: list[bool] = [False]  # for each open parenthesis, whether its select list is being read
    for i in solid:
        t, low = tokens[i], tokens[i].lower()
        nxt = tokens[after[i]].lower() if i in after else ""
        prev = tokens[before[i]].lower() if i in before else ""
        if t == "(":
            selecting.append(False)
        elif t == ")" and len(selecting) > 1:
            selecting.pop()
            if not nxt:
                continue
        elif low == "select":
            selecting[-1] = True
        elif low == "from":
            selecting[-1] = False
        if t[0] == "'" and len(t) > 1:
            if prev != "glob":
                out[i] = _literal(t[1:-1].replace("''", "'"))
        elif t[0] == '"' and len(t) > 1:
            name = t[1:-1].replace('""', '"')
            aliased = prev == "as"
            out[i] = f"`{name}`" if aliased or name.lower() in known | ROW_IDS | {"facts"} else _literal(name)
        elif t[0] == "[" and len(t) > 1:
            out[i] = f"`{t[1:-1]}`"
        elif low == "like":
            out[i] = "ILIKE"
        elif low == "glob" and nxt.startswith("'"):
            out[i] = "RLIKE"
            out[after[i]] = _literal(_of_glob(tokens[after[i]][1:-1].replace("''", "'")))
        elif low in ROW_IDS and prev != "as":
            whole = selecting[-1] and nxt in (",", "from") and prev in ("select", "distinct", ",", ".")
            out[i] = f"{row_id} AS {low}" if whole else row_id
        elif low in RENAMED and nxt == "(":
            out[i] = RENAMED[low]
            if low == "group_concat":
                depth, several, j = 0, False, after[i]
                while j in after:
                    depth += (tokens[j] == "(") - (tokens[j] == ")")
                    several |= depth == 1 and tokens[j] == ","
                    if not depth:
                        break
                    j = after[j]
                if not several and tokens[j] == ")":
                    out[j] = ", ',')"
    return "".join(out)
