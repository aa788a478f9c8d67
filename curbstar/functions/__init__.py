"""Pure column functions; all stay inside generated code."""
