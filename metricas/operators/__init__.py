"""Operators: normalise (P/F/U2), reshape (A/J5), join (J1-J4), deltas (D1/D2), merge (K)."""
