"""Tags and text of web pages: a state machine that goes over a page once and never raises, however broken the page is."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

#: Elements whose content is text up to their own end tag.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
OPENS, CLOSES = re.compile(r"<([A-Za-z][^\s/>]*)"), re.compile(r"</([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
TAG_END = re.compile(r"[\s/]*>")


def tokens(page: str, resolved: Callable[[str], str] = html.unescape) -> Iterator[tuple[str, str, dict[str, str]]]:
    """('start', name, attributes), ('end', name, {}) and ('text', text, {}) in the page's order; names in lower case.

    Comments and declarations are left out, also those that never end. Of equal attributes the first counts, and one without a value has ''. A tag that
    the page's end cuts off is no tag. Character references are resolved in text, titles and values, not in scripts and styles; str leaves them all
    as they are written.
    """
    at, end, raw = 0, len(page), None
    while at < end:
        if raw:
            close = re.compile(rf"</{re.escape(raw)}(?=[\s/>])", re.I).search(page, at)
            stop = close.start() if close else end
            if stop > at:
                yield "text", resolved(page[at:stop]) if raw in ("title", "textarea") else page[at:stop], {}
            at, raw = stop, None
        elif page[at] != "<":
            stop = page.find("<", at)
            stop = stop if stop >= 0 else end
            yield "text", resolved(page[at:stop]), {}
            at = stop
        elif page.startswith("<!--", at):
            at = after(page, "-->", at + 2)  # <!--> is a whole comment
        elif page.startswith(("<!", "<?"), at):
            at = after(page, ">", at)
        elif found := CLOSES.match(page, at):
            yield "end", found[1].lower(), {}
            at = after(page, ">", found.end())
        elif found := OPENS.match(page, at):
            name, attributes, at = found[1].lower(), {}, found.end()
            while more := ATTRIBUTE.match(page, at):
                attributes.setdefault(more[1].lower(), resolved(more[2] or more[3] or more[4] or ""))
                at = more.end()
            if not (closed := TAG_END.match(page, at)):
                return
            yield "start", name, attributes
            at, raw = closed.end(), name if name in RAW else None
        else:
            yield "text", "<", {}
            at += 1


def after(page: str, mark: str, at: int) -> int:
    """The place behind the next mark, or the page's end."""
    found = page.find(mark, at)
    return found + len(mark) if found >= 0 else len(page)
