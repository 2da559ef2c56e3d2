"""The operators and marts bound to the test tables, with comparison SQL."""
