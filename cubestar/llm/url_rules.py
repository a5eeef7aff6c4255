"""URL filter: pattern rules fetched by their rarest literal token.

Every rule is a regular expression. The literal tokens that a matching url must hold
as whole tokens follow from the expression: runs of letters and digits that stand
between characters which part tokens, whatever optional parts match. They are
counted over all urls, a rule is indexed by its rarest one, and the tokens of a url
fetch the few rules whose expressions then run on it; a rule without such a token is
fetched by every url. DataFrame functions only.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.llm.common import ascii_lower, bounded_broadcast

#: Rules beyond this number are joined by shuffle instead of broadcast.
MAX_BROADCAST_RULES = 100_000
#: Up to this number of tokens that index a rule, other tokens are dropped by a list.
MAX_LISTED_TOKENS = 20_000


@dataclass(frozen=True)
class Rule:
    """``subject`` is the column the expression runs on; ``rank`` orders fits."""

    name: str
    action: str
    kind: str
    subject: str
    pattern: str
    literals: tuple[str, ...]
    rank: int


def tokens_of(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(t for t in re.split("[^a-z0-9]+", text) if t))


def quoted(text: str) -> str:
    """A regular expression for exactly this text, for Java and for RE2."""
    return re.sub(r"([^A-Za-z0-9_/ -])", r"\\\1", text)


def site_rule(action: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``.

    Host labels and path segments that end with a slash are whole tokens of a
    fitting url; a last segment without one is not, as more may follow.
    """
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    closed = path[: path.rfind("/") + 1]
    lower = closed.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return Rule(
        host + path,
        action,
        "site",
        "site",
        rf"^(?:[^/]*\.)?{quoted(host)}{quoted(path)}" if path.startswith("/") else rf"^(?:[^/]*\.)?{quoted(host)}/{quoted(path)}",
        tokens_of(f"{host}/{lower}"),
        len(host + path),
    )


_TOKEN = set("abcdefghijklmnopqrstuvwxyz0123456789")


def _parts_tokens(member) -> bool:
    """Whether whatever a set or a single character matches parts tokens."""
    kind, value = member
    if kind is sre.LITERAL:
        return chr(value) not in _TOKEN
    if kind is sre.RANGE:
        return not any(value[0] <= ord(c) <= value[1] for c in _TOKEN)
    if kind is sre.IN:
        if value[0][0] is sre.NEGATE:
            held = {chr(v) for k, v in value[1:] if k is sre.LITERAL}
            for k, v in value[1:]:
                if k is sre.RANGE:
                    held |= {chr(c) for c in range(v[0], min(v[1], 127) + 1)}
            return _TOKEN <= held
        return all(_parts_tokens(m) for m in value)
    return kind is sre.AT


def _edge(items: list, outside: bool, last: bool) -> bool:
    """Whether a sequence begins (or ends) with what parts tokens; ``outside`` holds
    for what stands beyond it, which counts where the sequence may be empty."""
    for item in reversed(items) if last else items:
        kind, value = item
        if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, _, inner = value
            if not _edge(list(inner), True, last):
                return False
            if least:
                return True
        elif kind is sre.SUBPATTERN:
            # An empty group shows what stands beyond it.
            return _edge(list(value[-1]) or [], _rest(items, item, outside, last), last)
        elif kind is sre.BRANCH:
            beyond = _rest(items, item, outside, last)
            return all(_edge(list(b), beyond, last) for b in value[1])
        else:
            return _parts_tokens(item)
    return outside


def _rest(items: list, item, outside: bool, last: bool) -> bool:
    at = next(i for i, x in enumerate(items) if x is item)
    return _edge(items[:at] if last else items[at + 1 :], outside, last)


def _required(items: list, before: bool, after: bool) -> set[str]:
    """Whole tokens of every match of a sequence between given edges."""
    found: set[str] = set()
    at = 0
    while at < len(items):
        kind, value = items[at]
        opened = _edge(items[:at], before, True)
        if kind is sre.LITERAL and chr(value) in _TOKEN:
            end = at
            while end < len(items) and items[end][0] is sre.LITERAL and chr(items[end][1]) in _TOKEN:
                end += 1
            if opened and _edge(items[end:], after, False):
                found.add("".join(chr(v) for _, v in items[at:end]))
            at = end
            continue
        closed = _edge(items[at + 1 :], after, False)
        if kind is sre.SUBPATTERN:
            found |= _required(list(value[-1]), opened, closed)
        elif kind is sre.BRANCH:
            found |= set.intersection(*(_required(list(b), opened, closed) for b in value[1]))
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] == value[1] == 1:
            found |= _required(list(value[2]), opened, closed)
        at += 1
    return found


def required_tokens(pattern: str) -> tuple[str, ...]:
    """Tokens that every text with a match holds whole, as the expression tells.

    A match may stand inside a longer text, so an edge of the expression that is not
    anchored parts no tokens.
    """
    return tuple(sorted(_required(list(sre_parser.parse(pattern)), False, False)))


def pattern_rule(name: str, action: str, pattern: str) -> Rule:
    """Fits a url whose lower-cased text has a match of the expression."""
    return Rule(name, action, "pattern", "lowered", pattern, required_tokens(pattern), len(pattern))


_HOST = "://(?:[^/?#]*[.])?"

#: Name and expression of urls that are not worth a page.
DEFAULT_PATTERNS = (
    ("ad-tracker", "[./-]ads-track(?:ing)?[./?-]"),
    ("adult-host", _HOST + "adult-[a-z]{1,3}[0-9]*[.]"),
    ("betting", "[./-](?:free-bets|bets-for-free)[./?-]"),
    ("calendar-trap", "/calendar/[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}(?:[/?#]|$)"),
    ("casino-host", _HOST + "casino-(?:win|bonus|club)[0-9]*[.]"),
    ("comment-reply", "[?&]replytocom=[0-9]+"),
    ("deep-page", "[?&]page=[0-9]{4,}(?:[&#]|$)"),
    ("link-farm", _HOST + "(?:spam|link|seo)-farm[.]"),
    ("login-page", "/wp-login[.]php(?:[?#]|$)"),
    ("pill-shop", _HOST + "(?:buy|cheap|online)-pills(?:-[a-z0-9]+)*[.]"),
    ("program-file", "[.](?:apk|exe|msi)(?:[?#]|$)"),
    ("session-id", "[?&;]phpsessid=[0-9a-z]{16,}"),
)

DEFAULT_RULES = tuple(pattern_rule(name, "block", p) for name, p in DEFAULT_PATTERNS)


def host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; both are empty for a null or relative url."""
    after = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    return df.withColumn("_after", F.coalesce(after, F.lit(""))).withColumns(
        {
            "host": ascii_lower(F.regexp_extract("_after", r"^([^/?#]*)", 1)),
            "path": F.regexp_extract("_after", r"^[^/?#]*([^?#]*)", 1),
        }
    ).drop("_after")


def _rules_frame(spark, rules: list[Rule]) -> DataFrame:
    rows = [
        (i, r.name, r.action, r.kind, r.subject, r.pattern, list(r.literals), r.rank)
        for i, r in enumerate(rules)
    ]
    schema = (
        "rule_no long, name string, action string, kind string, subject string,"
        " pattern string, literals array<string>, rank long"
    )
    return spark.createDataFrame(rows, schema)


def _fetching(tokens: F.Column, rules: list[Rule]) -> F.Column:
    """Of a url's tokens those that may index a rule; '' stands for rules without any."""
    known = sorted({t for r in rules for t in r.literals})
    whole = F.array_union(F.array(F.lit("")), tokens)
    if len(known) > MAX_LISTED_TOKENS:
        return whole
    return F.array_intersect(whole, F.array(F.lit(""), *(F.lit(t) for t in known)))


def rarest_literals(urls: DataFrame, tokens: F.Column, rules: list[Rule]) -> DataFrame:
    """The rules with ``token``: the literal that the fewest urls hold.

    A rule without literals has the token '', which every url has.
    """
    frame = _rules_frame(urls.sparkSession, rules)
    literals = frame.select("rule_no", F.explode_outer("literals").alias("token"))
    counts = (
        urls.select(F.explode(_fetching(tokens, rules)).alias("token"))
        .where("token <> ''")
        .groupBy("token")
        .agg(F.count("*").alias("n_urls"))
    )
    # At most one count per token of a rule, so this side is as small as the rules.
    rarest = (
        literals.join(counts, "token", "left")
        .groupBy("rule_no")
        .agg(F.min(F.struct(F.coalesce("n_urls", F.lit(0)), F.coalesce("token", F.lit("")))).alias("_r"))
        .select("rule_no", F.col("_r.col2").alias("token"))
    )
    return frame.drop("literals").join(rarest, "rule_no")


def judge_urls(
    pages: DataFrame,
    site_rules: list[tuple[str, str, str]] = (),
    pattern_rules: tuple[Rule, ...] = DEFAULT_RULES,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``pattern`` to every row.

    ``rule`` is the longest fitting site rule (host, path as one text; of two
    equally long ones the smaller text). Where none fits, a fitting pattern rule
    decides (block before allow; ``pattern`` names the smallest), else ``default``.
    Null and empty urls fit nothing. Repeated rows and urls are judged alike;
    equal urls are judged once. Columns of the same names are replaced.
    """
    spark = pages.sparkSession
    kept = pages.drop("host", "path", "rule", "verdict", "pattern")
    rows = kept.select(F.struct("*").alias("row"), F.col(url).alias("url"))
    rules = [site_rule(*r) for r in site_rules] + list(pattern_rules)
    urls = host_and_path(
        rows.select(F.col("url").alias("_url")).where("_url IS NOT NULL").distinct(), "_url"
    )
    tokens = F.array_distinct(F.split(ascii_lower(F.col("_url")), "[^a-z0-9]+"))
    index = rarest_literals(urls, tokens, rules)
    subjects = urls.select(
        "_url",
        F.concat("host", "path").alias("site"),
        ascii_lower(F.col("_url")).alias("lowered"),
        F.explode(_fetching(tokens, rules)).alias("token"),
    )
    fits = (
        subjects.join(bounded_broadcast(index, len(rules), MAX_BROADCAST_RULES), "token")
        .where(
            F.expr("CASE subject WHEN 'site' THEN site RLIKE pattern ELSE lowered RLIKE pattern END")
        )
        .groupBy("_url")
        .agg(
            F.min(
                F.when(F.col("kind") == "site", F.struct(-F.col("rank"), "name", "action"))
            ).alias("_site"),
            F.min(
                F.when(
                    F.col("kind") != "site",
                    F.struct(F.when(F.col("action") == "block", 0).otherwise(1), "name", "action"),
                )
            ).alias("_pattern"),
        )
    )
    judged = rows.join(fits, F.col("url") == F.col("_url"), "left")
    return host_and_path(judged).select(
        "row.*",
        "host",
        "path",
        F.col("_site.name").alias("rule"),
        F.coalesce("_site.action", "_pattern.action", F.lit(default)).alias("verdict"),
        F.col("_pattern.name").alias("pattern"),
    )
