"""Patterns, formats and names that decide results.

Java (Spark) syntax. Patterns that both engines accept unchanged are also used
by the oracle SQL as they are.
"""

# A scheme in front of a link.
RX_SCHEME = r"^https?://"

# Website of a link: greedy up to the LAST two- or three-letter suffix that is
# followed by a slash. `(?d)` makes `.` exclude the newline only.
RX_WEBSITE = r"(?d)www\..*\.[a-z]{2,3}/"

# Strict variant: the host part only.
RX_WEBSITE_STRICT = r"www\.[^/\n]*\.[a-z]{2,3}/"

# What a page is read as, in this order: comments, script and style elements,
# elements whose content is text and no tags, and other tags. All but
# scripts and styles are kept (group 1), so a tag named in a comment, in a title or in a
# quoted value opens nothing, and a `>` in a quoted value ends no tag. What is
# never closed goes up to the end of the page. The signs `++` and `*+`
# (nothing is tried twice) are plain `+` and `*` where an engine never does.
_VALUES = r"""(?:=[\t\n\f\r ]*+(?:"[^"]*"|'[^']*')|=|[^>=]++)*+"""
_REST = rf"(?:[\t\n\f\r /]{_VALUES})?+(?:>|\z)"


def _element(names: str) -> str:
    return "|".join(rf"<{name}{_REST}.*?(?:</{name}(?:[\t\n\f\r /][^>]*+)?>|\z)" for name in names.split())


RX_NONTEXT = (
    r"(?is)(<!--.*?(?:-->|\z)"
    rf"|{_element('title textarea xmp iframe noembed noframes')})"
    rf"|{_element('script style')}"
    rf"|(</?[a-z][^\t\n\f\r />]*+{_REST})"
)
RX_NONTEXT_PLAIN = RX_NONTEXT.replace("++", "+").replace("*+", "*").replace("?+", "?")

# Runs of newline, pipe, tab, no-break space and space become one space.
RX_BLANKS = "[\n|\t\u00a0 ]+"
RX_BLANKS_KEEP_PIPES = "[\n\t\u00a0 ]+"

# A sentence keeps its full stop.
RX_SENTENCE = r"[^.]*\.|[^.]+"

# Tokens of the default tokenizer, and words for the phrase search.
RX_TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f\x0B]"
RX_WORD = r"\p{L}+"

# Unicode white space, for stripping at both ends.
WHITE_SPACE = (
    "\t\n\x0b\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

FETCH_SCHEME = "http://"
PAGE_SUFFIX = ".html"

# Label value that the loss ignores.
IGNORED_LABEL = -100

# Crawl counters, as a stats collector names them.
COUNTER_SAVED = "scrape/htmls_saved"
COUNTER_FAILED = "scrape/failed_permanently"
COUNTER_BACKLOG = "scrape/backlog_drawn"
COUNTER_REQUESTS = "downloader/request_count"
COUNTER_RESPONSES = "response_received_count"
COUNTER_BYTES = "downloader/response_bytes"
COUNTER_STATUS_PREFIX = "downloader/response_status_count/"

# Tags of metric points.
TAG_SAVED_RATE = "rate/htmls_per_min"
TAG_RESPONSE_RATE = "rate/responses_per_min"
TAG_REQUEST_RATE = "rate/requests_per_min"
TAG_FAILED_RATE = "rate/failed_permanently_per_min"
TAG_MB_RATE = "rate/mb_per_min"
TAG_STATUS_PREFIX = "http/"
TAG_STATUS_SUFFIX = "_per_min"
TAG_SAVED_TOTAL = "progress/htmls_saved_total"
TAG_FAILED_TOTAL = "progress/failed_permanently_total"
TAG_BACKLOG_TOTAL = "progress/backlog_drawn_total"
TAG_REMAINING = "progress/remaining"
TAG_RETRY_QUEUE = "progress/retry_queue"
