"""Column expressions: exact decimal numerics with SQL twins, calendar parts,
hash-based reproducible draws."""
