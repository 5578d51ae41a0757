"""Plain text of RTF: control words and groups are read, destinations without running text left out."""

from __future__ import annotations

import re

# Fixed values of the format: destinations without running text, and control words that stand for text.
SILENT = frozenset("annotation author colortbl comment datastore filetbl fldinst fonttbl footer footerf footerl footerr generator header headerf headerl headerr info keywords listtable listoverridetable object operator pict revtbl rsidtbl stylesheet themedata title xmlnstbl".split())
SHOWN = {"par": "\n", "line": "\n", "sect": "\n\n", "page": "\n\n", "row": "\n", "cell": "\t", "tab": "\t", "emdash": "—", "endash": "–", "bullet": "•", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”", "~": " ", "_": "-", "-": "", "\\": "\\", "{": "{", "}": "}", "\n": "\n", "\r": "\n"}

_TOKEN = re.compile(r"(?P<open>\{)|(?P<close>\})|\\'(?P<hex>[0-9a-fA-F]{2})|\\(?P<word>[a-zA-Z]+)(?P<number>-?[0-9]+)? ?|\\(?P<symbol>[^a-zA-Z])|(?P<text>[^\\{}\r\n]+)|[\r\n]+|\\", re.S)


def rtf_text(data: bytes) -> str | None:
    """The running text; None where the file is no RTF."""
    source = data.decode("latin-1")
    if not source.lstrip().startswith("{\\rtf"):
        return None
    out: list[str] = []
    # Of each open group: whether it is silent, and how many characters follow a \u for old readers.
    groups = [(False, 1)]
    skip = 0
    for token in _TOKEN.finditer(source):
        kind, value = token.lastgroup, token.group(token.lastgroup) if token.lastgroup else ""
        silent, after = groups[-1]
        if kind == "open":
            groups.append((silent, after))
            skip = 0
        elif kind == "close":
            if len(groups) > 1:
                groups.pop()
            skip = 0
        elif kind in ("word", "number"):
            word, number = token["word"], token["number"]
            if word in SILENT:
                groups[-1] = (True, after)
            elif word == "uc":
                groups[-1] = (silent, max(0, int(number or 1)))
            elif word == "u" and number is not None:
                if not silent:
                    out.append(chr(int(number) % 65536))
                skip = after
            elif word == "bin":
                return None  # raw bytes inside: the rest cannot be told apart
            elif word in SHOWN and not silent:
                out.append(SHOWN[word])
        elif kind == "symbol" and value == "*":
            groups[-1] = (True, after)
        elif kind == "hex" and skip:
            skip -= 1
        elif not silent and kind == "hex":
            out.append(bytes([int(value, 16)]).decode("cp1252", "replace"))
        elif not silent and kind == "symbol":
            out.append(SHOWN.get(value, ""))
        elif kind == "text":
            left, skip = value[skip:], max(0, skip - len(value))
            if not silent:
                out.append(left)
    # Two halves of one character come as two numbers.
    return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace").strip()
