from signalbox.cli import main

main()
