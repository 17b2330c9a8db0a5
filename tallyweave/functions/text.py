"""Word cleaning as built-in column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The edge marks stripped by the review report, and the ASCII punctuation and digits
# deleted by the content model.
EDGE_MARKS = "([,.!?:;])"
DELETED_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"

# Unicode white space plus the four separator controls and NEL, which Java's \s alone leaves out.
WHITE_SPACE = r"(?U)[\s\x1c-\x1f\x85]+"
NOT_WHITE_SPACE = r"(?U)[^\s\x1c-\x1f\x85]"


def words(text: Column) -> Column:
    """Lowercased text cut at white space; a leading or trailing cut leaves '' entries."""
    return F.split(F.lower(text), WHITE_SPACE)


def strip_edges(word: Column) -> Column:
    """Drop edge marks from both ends, keeping those inside the word."""
    return F.btrim(word, F.lit(EDGE_MARKS))


def words_without_marks(text: Column) -> Column:
    """Lowercased text with every punctuation mark and digit deleted, cut at white space."""
    return F.split(F.translate(F.lower(text), DELETED_MARKS, ""), WHITE_SPACE)
