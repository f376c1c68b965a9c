"""Clinical data operators as plain DataFrame-to-DataFrame functions."""
