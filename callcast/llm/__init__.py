"""Training-data operators: language ID, near and substring duplicates,
decontamination, mixing, URL filters, fingerprints, license scans, chat
rendering and web archives.  Nothing outside this folder imports it."""
