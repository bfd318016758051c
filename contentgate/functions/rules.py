"""Rule packs: each rule is a boolean column over the text of an item.

A pack is compiled to one CASE chain. The rules of a pack are put in the order in which
they win (see ``rules_for``), so the first branch that matches is the verdict and
later rules are not evaluated for that row. Listing every match is a separate projection.

Patterns use the common subset of the Java and RE2 dialects (no look-around, no
back-references, no word boundary) and none of them can match across a line feed, so
scanning the lines or messages of a text one by one finds exactly what scanning the
joined text finds. ``operators.scan.scan_chat`` depends on that. No group repeats without
bound either: Java matches such groups by recursion, and one long text could end the task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from contentgate.functions import taxonomy

PROMPT, SQL, FILE_PATH, FILE_CONTENT, A2A, CARD = (
    "prompt",
    "sql",
    "file_path",
    "file_content",
    "a2a_message",
    "agent_card",
)
KINDS = (PROMPT, SQL, FILE_PATH, FILE_CONTENT, A2A, CARD)

START = "(^|[^0-9A-Za-z_])"
END = "([^0-9A-Za-z_]|$)"
BLANKS = "[ \\t]+"

PATTERNS = {
    "ssn": START + "[0-9]{3}-[0-9]{2}-[0-9]{4}" + END,
    "card_run": "[0-9][0-9 -]{11,}[0-9]",
    "lettered": "[A-Za-z_][0-9A-Za-z_]*|[0-9]+[A-Za-z_][0-9A-Za-z_]*",
    "email_exposure": "[A-Za-z0-9._%+-]@[A-Za-z0-9][A-Za-z0-9.-]*[.][A-Za-z]{2}",
    "phone_number": START + "[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}" + END,
    "api_key": START + "(sk|pk|rk)[-_](live[-_]|test[-_]|proj[-_])?[0-9A-Za-z]{20,}",
    "secret_key": '(token|secret|api[_-]?key|password)"?[ \\t]*[=:][ \\t]*["\']?[0-9a-z_/+=-]{16,}',
    "aws_key": START + "(AKIA|ASIA)[0-9A-Z]{16}" + END,
    "private_key": "-----BEGIN ([A-Z]+ ){0,3}PRIVATE KEY-----",
    # the last literal may be open: its closing quote is often the attacked statement's own
    "tautology_or": "(^|[^0-9a-z_])or" + BLANKS + "('[^'\\n]*'|[0-9]+)[ \\t]*=[ \\t]*('[^'\\n]*|[0-9]+)",
    "tautology_and": "(^|[^0-9a-z_])and" + BLANKS + "('[^'\\n]*'|[0-9]+)[ \\t]*=[ \\t]*('[^'\\n]*|[0-9]+)",
    "union_injection": "(^|[^0-9a-z_])union" + BLANKS + "(all" + BLANKS + ")?select([^0-9a-z_]|$)",
    "stacked_query": ";[ \\t]*(drop|delete|insert|update|alter|truncate|exec|shutdown)([^0-9a-z_]|$)",
    "destructive_operation": (
        "(^|[^0-9a-z_])(drop" + BLANKS + "(table|database|schema)|truncate" + BLANKS + "table)([^0-9a-z_]|$)"
    ),
    "privilege_escalation": (
        "(^|[^0-9a-z_])(grant" + BLANKS + "all|sudo" + BLANKS + "su|chmod" + BLANKS + "(777|[+]s|u[+]s))([^0-9a-z_]|$)"
    ),
    "directory_traversal": "[.][.][/\\\\]|%2e%2e(%2f|/)",
    "sensitive_path": "/etc/(passwd|shadow|sudoers)|/[.]ssh/|/[.]aws/|/proc/self/",
    "sensitive_extension": "[.](pem|key|p12|pfx|jks|kdbx)($|[?#])",
    "blocked_extension": "[.](exe|bat|cmd|scr|dll|vbs)($|[?#])",
    "suspicious_tld": "https?://[0-9a-z.-]+[.](zip|mov|xyz|top|tk|click)([^0-9a-z.-]|$)",
    "reverse_shell": "/dev/tcp/[0-9a-z]|(^|[^0-9a-z_])nc[ \\t]+-[a-z]*e|bash[ \\t]+-i[ \\t]*>",
    "fork_bomb": ":[(][)][ \\t]*[{][ \\t]*:[ \\t]*[|][ \\t]*:",
    "instruction_override": (
        "(ignore|disregard|forget)" + BLANKS + "(all" + BLANKS + ")?(of" + BLANKS + ")?(the" + BLANKS
        + "|your" + BLANKS + ")?(previous|prior|above)"
    ),
}


def luhn_ok(digits: Column) -> Column:
    """The mod-10 check over a string of digits."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
    ))
    return F.aggregate(numbers, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def card_number(text: Column) -> Column:
    """A 13-19 digit number, single blanks or hyphens between its groups, that passes the mod-10 check.

    Other numbers may stand beside it: of each run of digit groups, every stretch of whole groups with 13 to 19
    digits is checked. Groups are never cut, and digits that touch a letter belong to no number. The cheap
    pattern runs first; runs are extracted only from rows that pass it.
    """
    runs = F.regexp_extract_all(F.regexp_replace(text, PATTERNS["lettered"], "x"), F.lit(PATTERNS["card_run"]), F.lit(0))

    def holds_card(groups: Column) -> Column:
        def starts_card(i: Column) -> Column:
            # 19 groups of one digit are the most a card can have
            return F.exists(F.sequence(F.lit(1), F.least(F.lit(19), F.size(groups) - i)), lambda n: is_card(F.slice(groups, i + 1, n)))

        return F.exists(F.sequence(F.lit(0), F.size(groups) - 1), starts_card)

    def is_card(window: Column) -> Column:
        number = F.array_join(window, "")
        return F.length(number).between(13, 19) & ~F.array_contains(window, "") & luhn_ok(number)

    return F.when(text.rlike("[0-9][0-9 -]{11}"), F.exists(F.transform(runs, lambda run: F.split(run, "[ -]")), holds_card)).otherwise(False)


class Subject(NamedTuple):
    """A text with what several rules derive from it, so that a table derives it once."""

    text: Column
    lower: Column
    digits: Column  # whether three digits stand together, which most prose lacks


def has_digits(text: Column) -> Column:
    return text.rlike("[0-9][ -]?[0-9][ -]?[0-9]")


def subject(text: Column | Subject) -> Subject:
    return text if isinstance(text, Subject) else Subject(text, F.lower(text), has_digits(text))


@dataclass(frozen=True)
class Rule:
    rule_id: str
    raw_type: str
    kinds: tuple[str, ...]
    test: Callable[[Subject], Column]
    score: float | None = None
    reason: str | None = None
    source: str = "content"  # which column the rule reads: content or body
    destructive: bool = False

    @property
    def public_type(self) -> str:
        return taxonomy.THREAT_ALIASES.get(self.raw_type, "unknown")

    def matches(self, content: Column | Subject, body: Column | Subject | None = None) -> Column:
        return F.coalesce(self.test(subject(content if self.source == "content" else body)), F.lit(False))


def _pattern(
    name: str, lowered: bool = False, hints: tuple[tuple[str, ...], ...] = (), quick: str | None = None,
    digits: bool = False,
) -> Callable[[Subject], Column]:
    """Match a named pattern, cheap tests first.

    Each entry of ``hints`` lists literals of which every match contains at least one, and
    ``quick`` is a faster pattern every match contains. They only save work: a substring
    search over the stored bytes is many times faster than a regular expression.
    """

    def test(s: Subject) -> Column:
        text = s.lower if lowered else s.text
        found = text.rlike(PATTERNS[name])
        if quick is not None:
            found = text.rlike(quick) & found
        for literals in reversed(hints):
            seen = text.contains(literals[0])
            for literal in literals[1:]:
                seen = seen | text.contains(literal)
            found = seen & found
        return s.digits & found if digits else found

    return test


TEXT_KINDS = (PROMPT, A2A, CARD)

# Rules, scores and reasons of the core pack; the first match wins.
CORE_RULES = (
    Rule(
        "core.instruction_override", "prompt_injection", TEXT_KINDS,
        lambda s: s.lower.contains("ignore previous"), 0.95, "Prompt injection detected",
    ),
    Rule(
        "core.ssn", "pii", TEXT_KINDS,
        lambda s: s.text.contains("SSN") | s.text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"), 0.99, "PII detected",
    ),
    Rule("core.tautology", "sql_injection", (SQL,), lambda s: s.text.contains("'1'='1'"), None, "SQL injection detected"),
    Rule(
        "core.drop_table", "sql_injection", (SQL,), lambda s: s.text.contains("DROP TABLE"), None,
        "SQL injection detected", destructive=True,
    ),
    Rule(
        "core.traversal", "path_traversal", (FILE_PATH, FILE_CONTENT),
        lambda s: s.text.contains("..") | s.text.contains("/etc/passwd"), None, "Path traversal detected",
    ),
)

# Detectors for the names of the taxonomy that fix a lexical class. Scores are this engine's own.
EXTENDED_RULES = (
    Rule("ext.private_key", "private_key", TEXT_KINDS, _pattern("private_key", hints=(("PRIVATE KEY-----",),)), 0.99),
    Rule("ext.aws_key", "aws_key", TEXT_KINDS, _pattern("aws_key", hints=(("AKIA", "ASIA"),)), 0.98),
    Rule("ext.api_key", "api_key", TEXT_KINDS,
         _pattern("api_key", hints=(("sk-", "sk_", "pk-", "pk_", "rk-", "rk_"),)), 0.95),
    Rule("ext.secret_key", "secret_key", TEXT_KINDS,
         _pattern("secret_key", lowered=True, hints=(("=", ":"), ("token", "secret", "key", "password"))), 0.9),
    Rule("ext.reverse_shell", "reverse_shell", TEXT_KINDS,
         _pattern("reverse_shell", lowered=True, hints=(("-", "/dev/tcp/"),), quick="nc[ \\t]+-|/dev/tcp/|bash"), 0.95),
    Rule("ext.fork_bomb", "fork_bomb", TEXT_KINDS, _pattern("fork_bomb", hints=((":(",),)), 0.97),
    Rule("ext.ssn", "ssn", TEXT_KINDS,
         _pattern("ssn", hints=(("-",),), quick="[0-9]{3}-[0-9]{2}-[0-9]{4}", digits=True), 0.95),
    Rule("ext.credit_card", "credit_card", TEXT_KINDS, lambda s: s.digits & card_number(s.text), 0.97),
    Rule("ext.email", "email_exposure", TEXT_KINDS, _pattern("email_exposure", hints=(("@",),)), 0.8),
    Rule("ext.phone", "phone_number", TEXT_KINDS, _pattern("phone_number", quick="[0-9]{3}[ .-][0-9]{4}", digits=True), 0.75),
    Rule("ext.instruction_override", "instruction_override", TEXT_KINDS,
         _pattern("instruction_override", lowered=True,
                  hints=(("previous", "prior", "above"), ("ignore", "disregard", "forget"))), 0.9),
    Rule("ext.suspicious_tld", "suspicious_tld", TEXT_KINDS,
         _pattern("suspicious_tld", lowered=True, hints=(("http",),)), 0.6),
    Rule("ext.tautology_or", "tautology_or", (SQL,),
         _pattern("tautology_or", lowered=True, hints=(("=",),)), 0.95),
    Rule("ext.tautology_and", "tautology_and", (SQL,),
         _pattern("tautology_and", lowered=True, hints=(("=",),)), 0.8),
    Rule("ext.union", "union_injection", (SQL,),
         _pattern("union_injection", lowered=True, hints=(("union",), ("select",))), 0.9),
    Rule("ext.stacked", "stacked_query", (SQL,), _pattern("stacked_query", lowered=True, hints=((";",),)), 0.85),
    Rule("ext.destructive", "destructive_operation", (SQL,),
         _pattern("destructive_operation", lowered=True, hints=(("drop", "truncate"),)), 0.85, destructive=True),
    Rule("ext.privilege", "privilege_escalation", (SQL, PROMPT),
         _pattern("privilege_escalation", lowered=True, hints=(("grant", "sudo", "chmod"),)), 0.8),
    Rule("ext.traversal", "directory_traversal", (FILE_PATH, FILE_CONTENT),
         _pattern("directory_traversal", lowered=True, hints=(("..", "%2e"),)), 0.9),
    Rule("ext.sensitive_path", "sensitive_path", (FILE_PATH, FILE_CONTENT),
         _pattern("sensitive_path", lowered=True, hints=(("/etc/", "/.ssh/", "/.aws/", "/proc/"),)), 0.9),
    Rule("ext.sensitive_extension", "sensitive_extension", (FILE_PATH, FILE_CONTENT),
         _pattern("sensitive_extension", lowered=True, hints=((".",),)), 0.7),
    Rule("ext.blocked_extension", "blocked_extension", (FILE_PATH, FILE_CONTENT),
         _pattern("blocked_extension", lowered=True, hints=((".",),)), 0.7),
)

# What the text of a file is searched for: the secret, personal-data and code detectors.
BODY_RULES = tuple(
    Rule(r.rule_id.replace("ext.", "body."), r.raw_type, (FILE_CONTENT,), r.test, r.score, r.reason, "body")
    for r in EXTENDED_RULES
    if r.public_type in ("secrets_exposure", "pii_exposure", "malicious_code")
)

PACKS = {
    "core": CORE_RULES,
    "extended": EXTENDED_RULES + BODY_RULES,
    # the core rules, and file bodies searched as well
    "core_bodies": CORE_RULES + BODY_RULES,
}


def rules_for(pack: str, kind: str, allow_destructive: bool = False) -> list[Rule]:
    """The rules of a pack that apply to a kind of item, in the order in which they win.

    Core rules come first, as listed. The others: highest severity, then highest score, then
    as listed. The rank depends on the rules alone, so it is settled here and not per row.
    """
    chosen = [r for r in PACKS[pack] if kind in r.kinds and not (allow_destructive and r.destructive)]
    rank = {name: i for i, name in enumerate(taxonomy.SEVERITIES)}
    core = [r for r in chosen if r in CORE_RULES]
    others = [r for r in chosen if r not in CORE_RULES]
    return core + sorted(others, key=lambda r: (rank[taxonomy.THREAT_SEVERITY[r.public_type]], -(r.score or 0.0)))


def winner(rules: list[Rule], content: Column | Subject, body: Column | Subject | None = None) -> Column:
    """1-based position of the winning rule, NULL when none matches."""
    position = F.lit(None).cast("int")
    chain = None
    for i, rule in enumerate(rules, start=1):
        hit = rule.matches(content, body)
        chain = F.when(hit, i) if chain is None else chain.when(hit, i)
    return position if chain is None else chain.cast("int")


def attribute(rules: list[Rule], position: Column, get: Callable[[Rule], object], dtype: str) -> Column:
    """An attribute of the winning rule, looked up by its position."""
    if not rules:
        return F.lit(None).cast(dtype)
    values = F.array(*[F.lit(get(r)).cast(dtype) for r in rules])
    return F.get(values, position - 1)


def hits(rules: list[Rule], content: Column | Subject, body: Column | Subject | None = None) -> Column:
    """Every matching rule of a row as array<struct>, in winning order."""
    dtype = "array<struct<rule_id:string,rule_ord:int,raw_threat_type:string,confidence_score:double>>"
    if not rules:
        return F.array().cast(dtype)
    slots = [
        F.when(
            r.matches(content, body),
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(i).cast("int").alias("rule_ord"),
                F.lit(r.raw_type).alias("raw_threat_type"),
                F.lit(r.score).cast("double").alias("confidence_score"),
            ),
        )
        for i, r in enumerate(rules, start=1)
    ]
    return F.array_compact(F.array(*slots))
