"""Column expressions for taxon names, numbers in text and localities. No UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(c: Column) -> Column:
    """Trimmed text; blank counts as missing."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*map(filled, columns))


def first_number(c: Column) -> Column:
    """The first decimal number in a text: '20 - 236 ft' is 20. Separators of thousands aren't known."""
    return F.nullif(F.regexp_extract(c, r"-?\d+(?:\.\d+)?", 0), F.lit("")).try_cast("double")


def lenient_long(c: Column) -> Column:
    """A whole number from text such as '12' or '12.0'; null for anything else."""
    value = c.cast("string").try_cast("double")
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def tri_state(c: Column) -> Column:
    """yes/true/1, no/false/0, else null."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin("yes", "true", "1"), True).when(word.isin("no", "false", "0"), False)


def derived_rank(name: Column) -> Column:
    """Rank from the form of a name; markers are case-sensitive and the first that fits decides."""
    n = F.trim(name)
    tokens = F.split(n, r"\s+")
    has = lambda *marks: reduce(lambda a, b: a | b, [n.contains(m) for m in marks])
    binomial = (F.size(tokens) >= 2) & F.element_at(tokens, 2).rlike(r"^\p{Ll}")
    return (
        F.when(filled(n).isNull(), "unknown")
        .when(has(" var. "), "variety")
        .when(has(" subsp. ", " ssp. "), "subspecies")
        .when(has(" f. ", " forma "), "form")
        .when(has("×", " x "), "hybrid")
        .when(F.when(F.size(tokens) >= 2, binomial).otherwise(False), "species")
        .when(F.size(tokens) == 1, "genus")
        .otherwise("unknown")
    )


INFRA = r"(?i)\s+(var\.|subsp\.|ssp\.|f\.|forma)\s+"


def name_variants(name: Column) -> Column:
    """Search forms from strict to loose: the name, what stands before an infraspecific mark, without hybrid marks, the first two words."""
    n = F.trim(F.coalesce(name, F.lit("")))
    tokens = F.filter(F.split(n, r"\s+"), lambda t: t != "")
    head = F.when(n.rlike(INFRA), F.trim(F.split(n, INFRA, 2)[0]))
    plain = F.when(n.contains("×") | n.contains(" x "), F.trim(F.replace(F.replace(n, F.lit("×"), F.lit("")), F.lit(" x "), F.lit(" "))))
    two = F.when(F.size(tokens) > 2, F.array_join(F.slice(tokens, 1, 2), " "))
    return F.array_distinct(F.filter(F.array(n, head, plain, two), lambda v: v.isNotNull() & (v != "")))


def clean_name(rank: Column, species: Column, genus: Column, infra: Column, cultivar: Column, scientific: Column) -> Column:
    """A name without authority, from the parts that fit its rank."""
    r, s, g, i, c = F.upper(filled(rank)), filled(species), filled(genus), filled(infra), filled(cultivar)
    under = lambda mark: F.concat(s, F.lit(f" {mark} "), i)
    whole = s.isNotNull() & i.isNotNull()
    return (
        F.when((r == "VARIETY") & whole, under("var."))
        .when((r == "SUBSPECIES") & whole, under("subsp."))
        .when(r.isin("FORM", "FORMA") & whole, under("f."))
        .when(c.isNotNull() & g.isNotNull(), F.concat(g, F.lit(" '"), c, F.lit("'")))
        .when((r == "SPECIES") & s.isNotNull(), s)
        .when((r == "GENUS") & g.isNotNull(), g)
        .otherwise(F.coalesce(s, g, filled(scientific), F.lit("")))
    )


def has_authority(name: Column) -> Column:
    """Whether a name carries its author or year."""
    return name.rlike(r"(\d{4}\)?|[A-Z]\.\s|Linn|et al\.|ex\s+[A-Z])")


# Word characters of the pattern are ASCII alone, so accented letters end a word.
_W = "[0-9A-Za-z_]"
IN_STATE = rf"(?i)(?<!{_W})(California(?!{_W})|CA(?!{_W})|Calif\.(?={_W}))"
BEYOND = r"(?i)Baja\s+California"


def ascii_word(words: list[str]) -> str:
    """A case-insensitive pattern for whole words, ASCII letters, digits and _ being word characters."""
    return rf"(?iu)(?<!{_W})(?:{'|'.join(words)})(?!{_W})"


def in_state(locality: Column) -> Column:
    text = F.coalesce(locality, F.lit(""))
    return text.rlike(IN_STATE) & ~text.rlike(BEYOND)
