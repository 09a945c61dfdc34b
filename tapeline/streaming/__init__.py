"""What exists on streams only: the stateful variant, sinks and run control."""
