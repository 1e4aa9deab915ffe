"""The models of the three layers."""
