"""Training-data operators: near-duplicates, neighbours, token counts, language-model
scores, quality, packing, personal data, secrets and source mixing.  Nothing outside this
package imports it; ``queries`` holds the registered queries."""
