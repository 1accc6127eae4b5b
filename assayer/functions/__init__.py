"""Column functions: no Python runs per row, so plans stay in code generation."""
