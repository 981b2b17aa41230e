from assay.cli import main

main()
