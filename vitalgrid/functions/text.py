"""ASCII text for plain-text reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Replacements in the order they are applied.
SYMBOLS = (
    ("σ", "std_dev"), ("Σ", "SIGMA"), ("μ", "mean"),
    ("↑", "[UP]"), ("↓", "[DOWN]"), ("→", "[RIGHT]"), ("←", "[LEFT]"),
    ("⚠️", "[ALERT]"), ("⚠", "[ALERT]"), ("✓", "[OK]"), ("✗", "[FAIL]"),
    ("•", "-"), ("◆", "*"), ("○", "o"), ("●", "*"), ("★", "*"), ("☆", "*"),
    ("™", "(TM)"), ("©", "(C)"), ("®", "(R)"),
    ("€", "EUR"), ("£", "GBP"), ("¥", "YEN"),
    ("°", " deg"), ("±", " +/- "), ("×", "x"), ("÷", "/"),
    ("≈", " approx "), ("≠", " != "), ("≤", " <= "), ("≥", " >= "),
    ("√", "sqrt"), ("∞", "inf"), ("∑", "sum"), ("∫", "integral"),
    ("∆", "DELTA"), ("λ", "lambda"), ("π", "pi"), ("θ", "theta"),
    ("Δ", "DELTA"), ("Ω", "OMEGA"),
    ("α", "alpha"), ("β", "beta"), ("γ", "gamma"), ("δ", "delta"),
    ("ε", "epsilon"), ("ζ", "zeta"), ("η", "eta"), ("κ", "kappa"),
    ("ν", "nu"), ("ρ", "rho"), ("τ", "tau"), ("υ", "upsilon"),
    ("φ", "phi"), ("χ", "chi"), ("ψ", "psi"), ("ω", "omega"),
    ("–", "-"), ("—", "-"), ("‐", "-"), ("‑", "-"), ("−", "-"),
    ("…", "..."), ("·", "."), ("‰", "/1000"),
    ("′", "'"), ("″", '"'), ("‴", "'''"), ("‵", "'"), ("‶", '"'),
    ("ʹ", "'"), ("ʺ", '"'), ("ʻ", "'"), ("ʼ", "'"), ("ʽ", "'"), ("ʾ", "'"), ("ʿ", "'"),
)

NON_ASCII = r"[^\x00-\x7F]"


def to_ascii(text: Column) -> Column:
    """Replace known symbols by words, then drop what is still not ASCII.

    Pure-ASCII text passes through; other text is only searched for the symbols
    found among its non-ASCII characters.
    """
    foreign = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    table = F.array(*[F.struct(F.lit(s).alias("symbol"), F.lit(w).alias("word")) for s, w in SYMBOLS])
    # The outer lambda computes the foreign characters once per text.
    present = F.flatten(F.transform(F.array(foreign), lambda chars: F.filter(
        table, lambda e: F.contains(chars, e["symbol"]))))
    replaced = F.aggregate(present, text, lambda out, e: F.replace(out, e["symbol"], e["word"]))
    return F.when(text.rlike(NON_ASCII), F.regexp_replace(replaced, NON_ASCII, "")).otherwise(text)
