"""Reading raw extracts, writing tables, and mapping the test tables to the canonical ones."""
