"""Text nodes of one page, by the standard library's parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

CUT_TAG = re.compile(r"</?[a-zA-Z][^>]*\Z")
HIDDEN = ("script", "style", "template")


class _Nodes(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[str] = []
        self.hidden = 0
        self.in_text = False

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in HIDDEN
        self.in_text = False

    def handle_startendtag(self, tag, attrs):
        self.in_text = False

    def handle_endtag(self, tag):
        self.hidden -= tag in HIDDEN and self.hidden > 0
        self.in_text = False

    def handle_comment(self, data):
        self.in_text = False

    def handle_data(self, data):
        if self.hidden:
            return
        # One text may come in pieces, around a stray bracket.
        if self.in_text:
            self.nodes[-1] += data
        else:
            self.nodes.append(data)
        self.in_text = True


def text_nodes(page: str) -> list[str]:
    parser = _Nodes()
    parser.feed(CUT_TAG.sub("", page))
    parser.close()
    return parser.nodes
