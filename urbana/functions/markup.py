"""Markdown messages as chat markup: a scanner of lines, and of the spans in them.

A message is cut into fenced code, which stays, and prose. Prose lines are classified; lines of text that follow each other are one
paragraph, and so are the rows of a table. Spans are found by one alternation, from left to right, and each kind has its ending in
a table; what a span holds is scanned again.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FENCE = re.compile(r"(```.*?```)", re.S)
NOTE = re.compile(r"\[\^([^\]]+)\]:[^\S\n]*(.*)")
HEADING = re.compile(r"\s*#+\s+(.+?)\s*#*$")
RULE = re.compile(r"\s*[-*_]{3,}\s*$")
BULLET = re.compile(r"(\s*)([-+*])\s+(.*)", re.S)
TASK = re.compile(r"\[[xX ]\]\s+")
RULER = re.compile(r"[\s|:-]+$")
SPAN = re.compile(
    r"(?P<code>`[^`\n]+`)"
    r"|!\[(?P<image>[^\]]*)\]\([^)\n]+\)"
    r"|\[\^(?P<mark>[^\]]+)\]"
    r"|\[[^\]]*\]\((?P<link>[^)\n]+)\)"
    r"|\*\*(?P<stars>.+?)\*\*|__(?P<bars>.+?)__|~~(?P<struck>.+?)~~"
    r"|(?<!\*)\*(?P<slanted>[^*\s][^*\n]*)\*(?!\*)"
    r"|</?(?P<tag>[bis])>",
    re.S,
)
#: What stands on either side of a span.
ENDS = {"stars": "*", "bars": "*", "struck": "~", "slanted": "_"}
TAGS = {"b": "*", "i": "_", "s": "~"}
# Fixed value: how the message service escapes a quoted text.
ESCAPED_QUOTE = re.compile(r"\{r'\\\"(.*?)\\\"'\}")


class Message:
    """One message: its notes by name, and the order in which they are first named."""

    def __init__(self, text: str):
        self.parts = FENCE.split(text.replace("\r\n", "\n"))  # every second part is code
        lines = [x for part in self.parts[::2] for x in part.split("\n")]
        self.notes = {m[1]: m[2].strip() for m in map(NOTE.fullmatch, lines) if m}
        self.named: dict[str, int] = {}

    def spans(self, text: str) -> str:
        return SPAN.sub(self.span, text)

    def span(self, m: re.Match) -> str:
        kind = m.lastgroup
        inner = m[kind]
        if kind in ENDS:
            return ENDS[kind] + self.spans(inner) + ENDS[kind]
        if kind == "mark":
            return f"[{self.named.setdefault(inner, len(self.named) + 1)}]" if inner in self.notes else ""
        return {"code": inner, "image": f"[Image: {inner}]", "link": inner, "tag": TAGS.get(inner, "")}[kind]

    def prose(self, text: str) -> str:
        out: list[str] = []
        plain: list[str] = []
        rows: list[str] = []

        def flush() -> None:
            if plain:
                out.append(self.spans("\n".join(plain)))
            if rows:
                out.append(table([self.spans(x) for x in rows]))
            plain.clear()
            rows.clear()

        for line in text.split("\n"):
            if NOTE.fullmatch(line):
                continue
            is_row = len(line) > 1 and line[0] == line.rstrip()[-1] == "|"
            heading, bullet = HEADING.match(line), BULLET.match(line)
            if (rows if not is_row else plain) or heading or bullet or RULE.match(line):
                flush()
            if is_row:
                rows.append(line)
            elif heading:
                while out and not out[-1].strip():
                    out.pop()
                out += [f"*{self.spans(heading[1])}*", ""]
            elif RULE.match(line):
                out.append("\n")
            elif bullet:
                out.append(f"{bullet[1]}{bullet[2]} {self.spans(TASK.sub('', bullet[3], 1) if TASK.match(bullet[3]) else bullet[3])}")
            else:
                plain.append(line)
        flush()
        return "\n".join(out)

    def rewritten(self) -> str:
        text = "".join(part if i % 2 else self.prose(part) for i, part in enumerate(self.parts))
        text = re.sub(r"\n{3,}", "\n\n", ESCAPED_QUOTE.sub(r'"\1"', text)).strip()
        if not self.named:
            return text
        return f"{text}\n\n---\n_Notas:_\n" + "\n".join(f"[{n}] {self.notes[k]}" for k, n in self.named.items()).rstrip()


def table(lines: list[str]) -> str:
    """Rows of cells between bars in columns of even width, as a block of code; nothing for a table without cells."""
    rows = [[c.strip() for c in x.split("|") if c.strip()] for x in lines if not RULER.match(x)]
    if not rows:
        return ""
    widths = [max(len(r[i]) for r in rows if i < len(r)) for i in range(max(map(len, rows)))]
    block = "\n".join(" | ".join((r[i] if i < len(r) else "").ljust(w) for i, w in enumerate(widths)) for r in rows)
    return f"\n```{block.strip()}```\n"


@F.pandas_udf(T.StringType())
def _rewritten(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: Message(t).rewritten(), na_action="ignore")


def chat_markup(c: Column) -> Column:
    """Bold, italics, strikes, headings, links, images, rules, tasks, tables and footnotes as chat markup; code stays as it is.

    Null gives null, an empty text an empty text. Footnotes are numbered as they are first named and listed at the end; marks
    of footnotes that are nowhere defined go. Messages go to Python in Arrow batches; nothing is grouped or shuffled.
    """
    return _rewritten(c)
