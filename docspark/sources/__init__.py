"""Filing tables in, result tables out."""
