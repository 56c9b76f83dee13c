"""String Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes, so trimming matches the reference.
# Tab, LF, VT, FF, CR, FS, GS, RS, US, space, NEL, NBSP, OGHAM SPACE MARK, EN QUAD .. HAIR SPACE,
# LINE SEPARATOR, PARAGRAPH SEPARATOR, NARROW NBSP, MEDIUM MATHEMATICAL SPACE, IDEOGRAPHIC SPACE.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace as Python's ``str.strip`` does."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(PY_WHITESPACE))


# Letters with case, by their Unicode properties: what Python's str.title starts and continues a word on.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"


def title_case(c: Column | str) -> Column:
    """Python ``str.title``: the first letter of every run of cased letters gets its title case, the rest lower case.

    ``initcap`` only capitalises after spaces; here a run starts after anything without case, so
    ``cote d'ivoire`` becomes ``Cote D'Ivoire``, and a letter after an ideograph starts one too. ``initcap`` of a single
    letter is its full title mapping (sharp s gives ``Ss``). A capital sigma is judged final within its run.
    """
    col = F.col(c) if isinstance(c, str) else c
    runs = F.regexp_extract_all(col, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), 1)
    def cap(x: Column) -> Column:
        # The tail is lowered behind a letter, as it stands in the text: that decides a capital sigma's form.
        tail = F.lower(F.concat(F.lit("a"), F.right(x, F.length(x) - 1)))
        return F.concat(F.initcap(F.substring(x, 1, 1)), F.right(tail, F.length(tail) - 1))

    capped = F.transform(runs, cap)
    return F.when(col.isNull(), F.lit(None)).otherwise(F.array_join(capped, ""))


def starts_with(c: Column | str, prefix: str) -> Column:
    """Null-safe, case-sensitive prefix test; a null value is *not* a match (it is kept by filters)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.startswith(prefix), F.lit(False))


def in_set(c: Column | str, values) -> Column:
    """Null-safe membership; a null value is not a member."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.isin(list(values)), F.lit(False))
