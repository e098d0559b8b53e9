"""Feature rules: new columns derived by fixed expressions where their sources exist."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.schema import quoted
from tabwright.functions.values import empty_to_null, strip


@dataclass(frozen=True)
class Rule:
    """``output`` = ``build(*sources)``; ``kind`` is the kind of the new column."""

    output: str
    sources: tuple[str, ...]
    build: Callable[..., Column]
    kind: str = "categorical"


# Builders by name: a rule is saved as the names and arguments of its steps.
BUILDERS: dict[str, Callable] = {}


def builder(make: Callable) -> Callable:
    """Register a function that returns a build step; what it returns remembers how it was made."""

    @wraps(make)
    def made(*args, **options):
        step = make(*args, **options)
        step.spec = {"step": make.__name__, "args": [_spec(a) for a in args], "options": options}
        return step

    BUILDERS[make.__name__] = made
    return made


def _spec(value):
    return {"build": spec_of(value)} if callable(value) else value


def spec_of(build: Callable) -> dict:
    """A build step as plain data."""
    if build is strip:
        return {"step": "strip"}
    if not hasattr(build, "spec"):
        raise ValueError("a rule built by a function of its own cannot be saved; register it with `builder`")
    return build.spec


def build_of(spec: dict) -> Callable:
    """The build step of plain data."""
    if spec["step"] == "strip":
        return strip
    args = [build_of(a["build"]) if isinstance(a, dict) and a.keys() == {"build"} else a for a in spec["args"]]
    return BUILDERS[spec["step"]](*args, **spec["options"])


def rules_to_data(rules: Sequence[Rule]) -> list[dict]:
    return [{"output": r.output, "sources": list(r.sources), "kind": r.kind, "build": spec_of(r.build)} for r in rules]


def rules_from_data(data: Sequence[dict]) -> list[Rule]:
    return [Rule(d["output"], tuple(d["sources"]), build_of(d["build"]), d["kind"]) for d in data]


@builder
def extract(pattern: str, group: int = 1, default: str | None = None) -> Callable[[Column], Column]:
    """First match of a pattern, or the default; texts are matched whole."""

    def build(c: Column) -> Column:
        found = empty_to_null(F.regexp_extract(c, pattern, group))
        return found if default is None else F.coalesce(found, F.lit(default))

    return build


@builder
def char_at(position: int, default: str) -> Callable[[Column], Column]:
    return lambda c: F.coalesce(empty_to_null(F.substring(c, position + 1, 1)), F.lit(default))


@builder
def map_values(mapping: dict[str, str], default: str) -> Callable[[Column], Column]:
    """Replace values by a fixed table; values outside it get the default."""

    def build(c: Column) -> Column:
        pairs = [F.lit(x) for pair in mapping.items() for x in pair]
        return F.coalesce(F.element_at(F.create_map(*pairs), c), F.lit(default))

    return build


@builder
def to_number(default: float) -> Callable[[Column], Column]:
    return lambda c: F.coalesce(c.try_cast("double"), F.lit(default))


@builder
def sum_plus(constant: int) -> Callable[..., Column]:
    """Sum of the sources plus a constant; missing if any source is."""

    def build(*cs: Column) -> Column:
        total = F.lit(constant)
        for c in cs:
            total = total + c
        return total

    return build


@builder
def equals_flag(value: int) -> Callable[[Column], Column]:
    """1 where the source equals the value, 0 otherwise and where missing."""
    return lambda c: F.coalesce((c == value).cast("int"), F.lit(0))


@builder
def then(*steps: Callable) -> Callable[..., Column]:
    """Chain builders: the first takes the sources, each next one the result."""

    def build(*cs: Column) -> Column:
        c = steps[0](*cs)
        for step in steps[1:]:
            c = step(c)
        return c

    return build


# Honorifics and the groups they stand for.
TITLE_GROUPS = {
    "Mr": "Mr",
    "Miss": "Miss",
    "Mrs": "Mrs",
    "Master": "Master",
    "Dr": "Professional",
    "Rev": "Professional",
    "Col": "Military",
    "Major": "Military",
    "Capt": "Military",
    "Countess": "Nobility",
    "Don": "Nobility",
    "Dona": "Nobility",
    "Jonkheer": "Nobility",
    "Lady": "Nobility",
    "Sir": "Nobility",
    "Mlle": "Miss",
    "Ms": "Miss",
    "Mme": "Mrs",
}

# Patterns of the passenger-list columns. (?U) takes all digits and spaces.
TITLE_PATTERN = r" ([A-Za-z]+)\."
TICKET_PREFIX_PATTERN = r"(?U)^([A-Za-z0-9\s]+)?\s*\d*$"
TICKET_NUMBER_PATTERN = r"(?U)(\d+)$"

PASSENGER_RULES = [
    Rule("Name_Title", ("Name",), then(extract(TITLE_PATTERN), map_values(TITLE_GROUPS, "Other"))),
    Rule("Cabin_Deck", ("Cabin",), char_at(0, "Unknown")),
    Rule("Ticket_Prefix", ("Ticket",), then(extract(TICKET_PREFIX_PATTERN, default="None"), strip)),
    Rule("Ticket_Number", ("Ticket",), then(extract(TICKET_NUMBER_PATTERN), to_number(0.0)), "numerical"),
    Rule("Family_Size", ("SibSp", "Parch"), sum_plus(1), "numerical"),
    Rule("Is_Alone", ("Family_Size",), equals_flag(1), "numerical"),
]

# Raw columns the rules use up.
USED_UP = ("Name", "Cabin", "Ticket")


def extract_features(
    df: DataFrame,
    rules: Sequence[Rule] = PASSENGER_RULES,
    drop: Sequence[str] = USED_UP,
) -> tuple[DataFrame, list[Rule]]:
    """Apply each rule whose sources are present, in order; later rules see earlier outputs."""
    applied = []
    for rule in rules:
        if all(s in df.columns for s in rule.sources):
            df = df.withColumn(rule.output, rule.build(*[F.col(quoted(s)) for s in rule.sources]))
            applied.append(rule)
    used = {s for r in applied for s in r.sources}
    return df.drop(*[c for c in drop if c in used]), applied
