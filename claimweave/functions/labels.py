"""Column expressions on labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source vocabulary of stance labels and the class each word belongs to.
STANCE_WORDS = {
    "SUPPORT": "SUPPORTS",
    "SUPPORTS": "SUPPORTS",
    "CONTRADICT": "REFUTES",
    "REFUTES": "REFUTES",
    "NOT_ENOUGH_INFO": "NEI",
    "NEI": "NEI",
}

# Words accepted as annotated evidence.
EVIDENCE_WORDS = ("SUPPORT", "SUPPORTS", "CONTRADICT", "REFUTES")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for item in mapping.items() for x in item])


def normalize_stance(c: Column | str) -> Column:
    """Class of a source stance word in any case; null if the word is unknown."""
    word = F.upper(_col(c))
    stance = None
    for target in ("SUPPORTS", "REFUTES", "NEI"):
        words = [w for w, s in STANCE_WORDS.items() if s == target]
        hit = word.isin(words)
        stance = F.when(hit, target) if stance is None else stance.when(hit, target)
    return stance


def label_to_id(c: Column | str, labels: dict[str, int]) -> Column:
    return F.try_element_at(_literal_map(labels), _col(c))


def id_to_label(c: Column | str, labels: dict[str, int]) -> Column:
    return F.try_element_at(_literal_map({v: k for k, v in labels.items()}), _col(c).cast("int"))


def label_names(labels: dict[str, int]) -> list[str]:
    """Label names in id order."""
    return sorted(labels, key=labels.get)
