"""Where messages come from: scans, decoders and table change feeds."""
