"""Composed jobs: session analysis (J1), page conversion (J2), area top products (J3), ad clicks in batch."""
