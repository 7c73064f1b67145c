"""The registered queries: library operators over the test tables, with equivalent SQL."""
