"""Texts shared by the tests."""

PROSE = ("The quick brown fox jumps over the lazy dog while seven wise owls read long letters near the old stone bridge "
         "and a small boat drifts slowly down the quiet river toward the distant harbour lights of the sleeping town.")
