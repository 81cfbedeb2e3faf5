"""The load stages and their published output."""
