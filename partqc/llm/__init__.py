"""Operators for building training corpora, and the queries that apply them.

Nothing outside this subpackage imports it.  Module per operator:

  fingerprint   threshold-scaled sketches of word shingles          (native)
  sentencepiece n-best segmentation of a piece lattice, decoding
  pii           personal data: patterns, checksums, context         (native)
  quality       positive-unlabelled quality classifier
  mixing        temperature mixing of sources                       (native)
  jaccard       n-gram Jaccard join over a token-group matrix
  lm            cross-entropy difference of two n-gram models
  langid        cross-parsing language identification
  linededup     content-defined line chunks
  ann           int8 block matrix nearest neighbours
  covertree     product codes by Lloyd rounds over cover trees
  merkle        postorder append logs of a Merkle manifest
  licenses      exact containment join of text blocks and license notices

``queries`` registers one query per operator, ``oracle`` the SQL of those SQL
can express, ``words`` and ``common`` are shared helpers.
"""
