"""Pure Column expressions, shared by batch and stream."""
