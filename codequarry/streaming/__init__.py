"""Nothing here is stateful: there is no watermark, window or late data to rebuild.

The row-wise operators take streaming DataFrames as they are, so newly arriving files can be admitted,
decoded and labelled as they come: ``sources.files`` (``include_paths``, ``exclude_paths``,
``language_filter``, ``admit``, ``decode_text``, ``detect_language``), ``lines.source_lines`` and
``lexical.masked``. Everything else works on the tables such a stream writes.
"""
